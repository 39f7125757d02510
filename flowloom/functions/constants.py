"""Domain vocabulary.

Fixed values: class names, severities, actions, aliases, keywords, thresholds and column names
below are part of the results and must stay exactly as written.
"""

# Attack classes with severity and recommended action.
CLASS_SEVERITY = {
    "BENIGN": "Faible",
    "Bot": "Elevee",
    "DDoS": "Critique",
    "DoS GoldenEye": "Critique",
    "DoS Hulk": "Critique",
    "DoS Slowhttptest": "Elevee",
    "DoS slowloris": "Elevee",
    "FTP-Patator": "Elevee",
    "Heartbleed": "Critique",
    "Infiltration": "Critique",
    "PortScan": "Elevee",
    "SSH-Patator": "Elevee",
    "Web Attack - Brute Force": "Elevee",
    "Web Attack - SQL Injection": "Critique",
    "Web Attack - XSS": "Elevee",
}
CLASSES = list(CLASS_SEVERITY)
CLASS_ACTION = {
    "BENIGN": "Aucune action requise",
    "Bot": "Isoler la machine et analyser le processus suspect",
    "DDoS": "Activer la mitigation DDoS et analyser le trafic",
    "DoS GoldenEye": "Limiter le trafic et surveiller le service cible",
    "DoS Hulk": "Bloquer la source et renforcer les regles IDS",
    "DoS Slowhttptest": "Limiter les connexions lentes vers le serveur",
    "DoS slowloris": "Limiter les sessions longues et surveiller le serveur",
    "FTP-Patator": "Bloquer la source et verifier les tentatives FTP",
    "Heartbleed": "Isoler le service et verifier la version OpenSSL",
    "Infiltration": "Isoler l'hote et lancer une investigation",
    "PortScan": "Surveiller puis bloquer l'adresse source",
    "SSH-Patator": "Bloquer la source et renforcer l'authentification SSH",
    "Web Attack - Brute Force": "Bloquer la source et verifier les journaux web",
    "Web Attack - SQL Injection": "Bloquer la requete et verifier l'application web",
    "Web Attack - XSS": "Bloquer la requete et filtrer les entrees utilisateur",
}
DEFAULT_ACTION = "Analyser l'evenement et verifier les journaux"
DEFAULT_SEVERITY = "Moyenne"
LOWEST_SEVERITY = "Faible"
MISSING_LABEL = "LABEL_MANQUANT"
UNDEFINED = "Non defini"
OTHER_ATTACKS = "Autres attaques"

# Severity order, spelling variants, numeric levels of the IDS.
SEVERITY_PRIORITY = {"Critique": 1, "Elevee": 2, "Moyenne": 3, "Faible": 4}
SEVERITY_VARIANTS = {"Eleve": "Elevee", "Moyen": "Moyenne"}
IDS_LEVELS = {1: "Critique", 2: "Elevee", 3: "Moyenne"}

# Processing status.
OPEN, DONE = "Non traitee", "Traitee"
STATUS_VARIANTS = {"Nouvelle": "Non traitee", "Normal": "Traitee", "": "Non traitee"}

# Risk level and score per highest open severity; default scores per level.
RISK = {
    "Critique": ("Critique", 100),
    "Elevee": ("Eleve", 75),
    "Moyenne": ("Modere", 50),
    "Faible": ("Faible", 25),
}
NO_RISK = ("Maitrise", 0)
RISK_LEVEL_SCORES = {
    "MAITRISE": 15, "FAIBLE": 25, "MODERE": 50, "MOYEN": 50, "ELEVE": 75, "ELEVEE": 75, "CRITIQUE": 95,
}

# Keywords that must all occur, tried in order, and the class they mean.
LABEL_KEYWORDS = [
    (("sql",), "Web Attack - SQL Injection"),
    (("xss",), "Web Attack - XSS"),
    (("brute", "web"), "Web Attack - Brute Force"),
    (("port", "scan"), "PortScan"),
    (("goldeneye",), "DoS GoldenEye"),
    (("hulk",), "DoS Hulk"),
    (("slowhttptest",), "DoS Slowhttptest"),
    (("slowloris",), "DoS slowloris"),
    (("ddos",), "DDoS"),
    (("ssh",), "SSH-Patator"),
    (("ftp",), "FTP-Patator"),
]
IDS_KEYWORDS = [
    (("sql",), "Web Attack - SQL Injection"),
    (("xss",), "Web Attack - XSS"),
    (("brute", "web"), "Web Attack - Brute Force"),
    (("scan",), "PortScan"),
    (("ddos",), "DDoS"),
    (("dos",), "DoS Hulk"),
    (("denial",), "DoS Hulk"),
    (("ssh",), "SSH-Patator"),
    (("ftp",), "FTP-Patator"),
    (("trojan",), "Bot"),
    (("malware",), "Bot"),
    (("bot",), "Bot"),
]
UNNAMED_ALERT = "Alerte Suricata"
WEB_LABEL_PATTERNS = {
    r"web\s*attack.*brute\s*force": "Web Attack - Brute Force",
    r"web\s*attack.*sql\s*injection": "Web Attack - SQL Injection",
    r"web\s*attack.*xss": "Web Attack - XSS",
}

# Names that mean harmless traffic, after accent folding.
BENIGN_KEYS = ["BENIGN", "BENIN", "NORMAL", "NORMAL TRAFFIC", "TRAFFIC NORMAL", "TRAFIC NORMAL"]
ACCENTED, PLAIN = "ÉÈÊÀÂÎÔÙÛ", "EEEAAIOUU"

# Short names of capture files by name fragment, in order.
SHORT_NAMES = [
    ("monday", "Monday"),
    ("tuesday", "Tuesday"),
    ("wednesday", "Wednesday"),
    ("webattacks", "Thu-WebAttacks"),
    ("infilteration", "Thu-Infiltration"),
    ("infiltration", "Thu-Infiltration"),
    ("ddos", "Fri-DDoS"),
    ("portscan", "Fri-PortScan"),
    ("friday-workinghours-morning", "Fri-Morning"),
]

EXPECTED_FILES = [
    "Friday-WorkingHours-Afternoon-DDos.pcap_ISCX.csv",
    "Friday-WorkingHours-Afternoon-PortScan.pcap_ISCX.csv",
    "Friday-WorkingHours-Morning.pcap_ISCX.csv",
    "Monday-WorkingHours.pcap_ISCX.csv",
    "Thursday-WorkingHours-Afternoon-Infilteration.pcap_ISCX.csv",
    "Thursday-WorkingHours-Morning-WebAttacks.pcap_ISCX.csv",
    "Tuesday-WorkingHours.pcap_ISCX.csv",
    "Wednesday-workingHours.pcap_ISCX.csv",
]

# Thresholds of the flow rules and the field names they accept.
DDOS_PACKETS_PER_S, DDOS_BYTES_PER_S, HULK_PACKETS_PER_S = 150_000, 80_000_000, 20_000
SSH_PORTS, FTP_PORTS, WEB_PORTS = ["22", "2222"], ["21", "20"], ["80", "443", "8080"]
BRUTE_FORCE_PACKETS, SCAN_DURATION, SCAN_PACKETS = 15, 2_000, 4
RULE_FIELDS = {
    "port": ["Destination Port", "dest_port", "destination_port", "dp"],
    "bytes": ["Flow Bytes/s", "flow_bytes_s", "flow.bytes/s"],
    "packets": ["Flow Packets/s", "flow_packets_s", "flow.packets/s"],
    "fwd": ["Total Fwd Packets", "tot_fwd_pkts"],
    "duration": ["Flow Duration", "duration"],
}
SCALED_LOW, SCALED_HIGH = -0.05, 1.05
LABEL_FIELDS = ["Label", "label", "Classe", "classe", "attack_class", "Attack"]

# Alert register columns, legacy names, display names and values.
HISTORY_COLUMNS = [
    "user_id", "date", "source", "fichier", "classe", "nombre", "gravite", "action_recommandee",
    "ip_source", "ip_destination", "protocole", "statut", "notification_email",
    "erreur_notification_email", "details", "mode_analyse", "event_id",
]
LEGACY_COLUMNS = {
    "timestamp": "date",
    "attack_class": "classe",
    "severity": "gravite",
    "status": "statut",
    "action": "action_recommandee",
    "source_ip": "ip_source",
    "destination_ip": "ip_destination",
}
INTERNAL_COLUMNS = ["user_id", "historique_id", "historique_type", "historique_index", "event_id"]
DISPLAY_COLUMNS = {
    "date": "Horodatage",
    "source": "Moteur de détection",
    "fichier": "Élément analysé",
    "filename": "Élément analysé",
    "classe": "Type de menace",
    "signature": "Signature IDS",
    "categorie": "Catégorie IDS",
    "nombre": "Occurrences",
    "pourcentage": "Part des flux (%)",
    "gravite": "Niveau de sévérité",
    "action_recommandee": "Mesure de réponse recommandée",
    "ip_source": "Adresse IP source",
    "ip_destination": "Adresse IP de destination",
    "protocole": "Protocole réseau",
    "statut": "Statut de traitement",
    "notification_email": "État de notification",
    "erreur_notification_email": "Diagnostic de notification",
    "details": "Détails techniques",
    "mode_analyse": "Moteur d'analyse",
    "canal": "Canal de diffusion",
    "erreur": "Diagnostic",
}
DISPLAY_VALUES = {
    "CSV": "Moteur IA",
    "Suricata": "IDS Suricata",
    "Critique": "Critique",
    "Elevee": "Élevée",
    "Moyenne": "Moyenne",
    "Faible": "Faible",
    "Non traitee": "À traiter",
    "Traitee": "Traité",
    "Envoyee": "Transmis",
    "Envoye": "Transmis",
    "Echec": "Échec",
    "Maitrise": "Maîtrisé",
    "Eleve": "Élevé",
    "Modere": "Modéré",
    "Operationnel": "Opérationnel",
    "Operationnelle": "Opérationnelle",
    "Degrade": "Dégradé",
}
DISPLAYED = ["source", "gravite", "statut", "notification_email"]
SERIES_ALIASES = {
    "horodatage": ["horodatage", "date", "periode", "timestamp", "time"],
    "benin": ["benin", "benign", "trafic_benin", "flux_benins", "normal"],
    "malveillant": ["malveillant", "malicious", "trafic_malveillant", "flux_malveillants", "attaques"],
}

# Flow features in file order; the raw header repeats "Fwd Header Length".
FLOW_FEATURES = [
    "Destination Port", "Flow Duration", "Total Fwd Packets", "Total Backward Packets",
    "Total Length of Fwd Packets", "Total Length of Bwd Packets", "Fwd Packet Length Max",
    "Fwd Packet Length Min", "Fwd Packet Length Mean", "Fwd Packet Length Std",
    "Bwd Packet Length Max", "Bwd Packet Length Min", "Bwd Packet Length Mean",
    "Bwd Packet Length Std", "Flow Bytes/s", "Flow Packets/s", "Flow IAT Mean", "Flow IAT Std",
    "Flow IAT Max", "Flow IAT Min", "Fwd IAT Total", "Fwd IAT Mean", "Fwd IAT Std", "Fwd IAT Max",
    "Fwd IAT Min", "Bwd IAT Total", "Bwd IAT Mean", "Bwd IAT Std", "Bwd IAT Max", "Bwd IAT Min",
    "Fwd PSH Flags", "Bwd PSH Flags", "Fwd URG Flags", "Bwd URG Flags", "Fwd Header Length",
    "Bwd Header Length", "Fwd Packets/s", "Bwd Packets/s", "Min Packet Length",
    "Max Packet Length", "Packet Length Mean", "Packet Length Std", "Packet Length Variance",
    "FIN Flag Count", "SYN Flag Count", "RST Flag Count", "PSH Flag Count", "ACK Flag Count",
    "URG Flag Count", "CWE Flag Count", "ECE Flag Count", "Down/Up Ratio", "Average Packet Size",
    "Avg Fwd Segment Size", "Avg Bwd Segment Size", "Fwd Header Length.1", "Fwd Avg Bytes/Bulk",
    "Fwd Avg Packets/Bulk", "Fwd Avg Bulk Rate", "Bwd Avg Bytes/Bulk", "Bwd Avg Packets/Bulk",
    "Bwd Avg Bulk Rate", "Subflow Fwd Packets", "Subflow Fwd Bytes", "Subflow Bwd Packets",
    "Subflow Bwd Bytes", "Init_Win_bytes_forward", "Init_Win_bytes_backward", "act_data_pkt_fwd",
    "min_seg_size_forward", "Active Mean", "Active Std", "Active Max", "Active Min", "Idle Mean",
    "Idle Std", "Idle Max", "Idle Min",
]
