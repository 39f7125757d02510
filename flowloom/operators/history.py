"""The alert register: normalising, appending, deduplicating, filtering, updating."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import constants as K
from ..functions.labels import action_of, canonical_attack, is_benign
from ..functions.rules import ids_class, ids_severity
from ..functions.scalars import (
    col, event_id, normalize_severity, normalize_status, occurrences, parse_time, priority, text,
)
from ..plans.bounded import lookup_join
from ..sources.sinks import display, export_register, register_filter  # noqa: F401


def normalize_alerts(events: DataFrame, now: Column | None = None) -> DataFrame:
    """Alert events of the IDS log in register form (ten columns)."""
    now = now if now is not None else F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss")
    alert = lambda n: text(F.col(f"alert.{n}"))
    fields = {n: F.col(n) for n in ("timestamp", "flow_id", "src_ip", "src_port", "dest_ip", "dest_port", "proto")}
    fields |= {n: F.col(f"alert.{n}") for n in ("signature_id", "rev", "signature")}
    signature = F.coalesce(F.nullif(F.col("alert.signature"), F.lit("")), F.col("signature"))
    classe = ids_class(signature, F.col("alert.category"))
    return (
        events.filter(F.col("event_type") == "alert")
        .select(
            event_id(fields).alias("event_id"),
            F.coalesce(F.col("timestamp"), now).alias("date"),
            text(F.col("src_ip")).alias("ip_source"),
            text(F.col("dest_ip")).alias("ip_destination"),
            text(F.col("proto")).alias("protocole"),
            alert("signature").alias("signature"),
            alert("category").alias("categorie"),
            classe.alias("classe"),
            ids_severity(F.col("alert.severity")).alias("gravite"),
        )
        .withColumn("action_recommandee", action_of(F.col("classe")))
    )


def to_history(df: DataFrame, source: str, file: str, user: Column | str, now: Column | None = None, mode: Column | None = None) -> DataFrame:
    """Register rows from scoring details (source CSV) or normalised alerts (source Suricata)."""
    user = F.lit(user) if isinstance(user, str) else user
    blank = F.lit("")
    shared = {
        "user_id": user, "source": F.lit(source), "fichier": F.lit(file),
        "gravite": normalize_severity(F.col("gravite")), "statut": F.lit(K.OPEN),
        "notification_email": blank, "erreur_notification_email": blank,
    }
    if source == "CSV":
        own = {
            "date": now if now is not None else F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss"),
            "classe": F.col("classe"), "nombre": F.col("nombre").cast("long"),
            "action_recommandee": F.col("action_recommandee"), "ip_source": blank, "ip_destination": blank,
            "protocole": blank, "details": F.lit("Analyse des flux CIC-IDS2017"),
            "mode_analyse": mode if mode is not None else blank, "event_id": blank,
        }
    else:
        own = {
            "date": F.col("date"), "classe": F.coalesce(F.nullif(F.col("classe"), blank), F.col("signature")),
            "nombre": F.lit(1).cast("long"), "action_recommandee": action_of(F.col("classe")),
            "ip_source": F.col("ip_source"), "ip_destination": F.col("ip_destination"),
            "protocole": F.col("protocole"), "details": F.col("signature"),
            "mode_analyse": F.lit("Suricata eve.json"), "event_id": F.col("event_id"),
        }
    values = shared | own
    return df.select(*[values[c].alias(c) for c in K.HISTORY_COLUMNS])


def append_history(old: DataFrame, new: DataFrame) -> DataFrame:
    """Union by name; a column one side lacks is empty there."""
    both = old.unionByName(new, allowMissingColumns=True)
    texts = {c: F.coalesce(col(c), F.lit("")) for c, kind in both.dtypes if kind == "string"}
    return both.withColumns(texts)


def normalize_history(df: DataFrame, source: str) -> DataFrame:
    """Legacy names, missing columns, default source, severity and status variants."""
    wanted = {old: new for old, new in K.LEGACY_COLUMNS.items() if old in df.columns and new not in df.columns}
    df = df.withColumns({new: col(old) for old, new in wanted.items()})
    df = df.withColumns({c: F.lit("") for c in K.HISTORY_COLUMNS if c not in df.columns})
    texts = {c: F.coalesce(col(c), F.lit("")) for c, kind in df.dtypes if kind == "string"}
    df = df.withColumns(texts)
    return df.withColumns(
        {
            "source": F.when(F.col("source") == "", source).otherwise(F.col("source")),
            "gravite": normalize_severity(F.col("gravite")),
            "statut": normalize_status(F.col("statut")),
        }
    )


def backfill_owner(df: DataFrame, owner: str) -> DataFrame:
    if "user_id" not in df.columns:
        return df.withColumn("user_id", F.lit(owner))
    return df.withColumn(
        "user_id", F.when(F.trim(text(F.col("user_id"))) == "", owner).otherwise(F.col("user_id").cast("string"))
    )


def for_user(df: DataFrame, user: str) -> DataFrame:
    return df.filter(F.col("user_id") == user)


def facet_values(df: DataFrame, c: str) -> DataFrame:
    """Sorted distinct non-empty values of a filter column."""
    return df.select(col(c).cast("string").alias("value")).filter(F.col("value") != "").distinct().orderBy("value")


def prepare_history(df: DataFrame) -> DataFrame:
    """Add the parsed date, the clipped count and the benign flag."""
    date = parse_time(F.col("date")) if "date" in df.columns else F.lit(None).cast("timestamp")
    count = occurrences(F.col("nombre")) if "nombre" in df.columns else F.lit(1.0)
    if "classe" not in df.columns:
        df = df.withColumn("classe", F.lit("Non définie"))
    return df.withColumns({"_date": date, "_occurrences": count, "_benin": is_benign(F.col("classe"))})


def period_filter(df: DataFrame, ts: str, delta: str | None, now: Column) -> DataFrame:
    """Rows of the last ``delta`` before the later of ``now`` and the newest row.

    No period, or a table without any date, keeps every row.
    """
    newest = df.agg(F.max(ts)).first()[0] if delta is not None else None
    if newest is None:
        return df
    # one value is fetched, so that the bound is a literal the scan can prune with
    reference = F.greatest(now, F.lit(newest).cast(df.schema[ts].dataType))
    return df.filter(F.col(ts) >= reference - F.expr(f"INTERVAL {delta}"))


def dedup_batch(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """First row per key in ``order``; rows whose last key is empty all stay.

    Ties go by the other columns from left to right, so the input's order does not matter. The smallest
    row is kept by an aggregate, so a repeated id is reduced before the shuffle.
    """
    blank = F.coalesce(col(keys[-1]).cast("string"), F.lit("")) == ""
    rest = [c for c in df.columns if c not in (*order, *keys)]
    row = F.struct(*[col(c) for c in (*order, *rest)])
    first = df.filter(~blank).groupBy(*keys).agg(F.min(row).alias("_r"))
    picked = first.select(*[col(c) if c in keys else F.col("_r")[c].alias(c) for c in df.columns])
    return picked.unionByName(df.filter(blank))


def new_only(batch: DataFrame, history: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is not stored yet; rows with an empty id always pass."""
    blank = F.coalesce(col(keys[-1]).cast("string"), F.lit("")) == ""
    stored = history.select(*[col(k) for k in keys]).distinct()
    fresh = batch.filter(~blank).join(stored, keys, "left_anti").select(*batch.columns)
    return fresh.unionByName(batch.filter(blank))


def update_status(history: DataFrame, updates: DataFrame, user: str, key: str = "historique_id") -> DataFrame:
    """Apply (key, statut) updates to the rows of ``user``; other statuses and owners are ignored.

    Of several updates to one row the one with the highest ``seq`` counts.
    """
    valid = updates.filter(F.col("statut").isin(K.OPEN, K.DONE))
    last = valid.groupBy(key).agg(F.max_by("statut", "seq").alias("_new"))
    joined = lookup_join(history, last, [key])
    changed = (F.col("user_id") == user) & F.col("_new").isNotNull()
    return joined.withColumn("statut", F.when(changed, F.col("_new")).otherwise(F.col("statut"))).drop("_new")


def latest_alerts(
    history: DataFrame, n: int = 5, ts: str = "date", tie: str = "event_id", user: str | None = None
) -> DataFrame:
    """The newest n alerts with the panel columns; with ``user``, only of that owner."""
    panel = ["date", "classe", "gravite", "ip_source", "ip_destination", "protocole", "statut"]
    if n < 1:
        raise ValueError("at least one alert must be asked for")
    history = history if user is None else for_user(history, user)
    return history.orderBy(F.col(ts).desc(), F.col(tie).desc()).limit(n).select(*panel)


def recent_events(prepared: DataFrame, n: int = 8, tie: str = "event_id") -> DataFrame:
    """Newest rows in display form, blanks named."""
    shown = ["date", "ip_source", "ip_destination", "classe", "gravite", "statut"]
    rows = prepared.orderBy(F.col("_date").desc_nulls_last(), F.col(tie)).limit(n)
    filled = rows.select(*[F.coalesce(F.nullif(col(c).cast("string"), F.lit("")), F.lit("Non renseigné")).alias(c) for c in shown])
    return display(filled)


def to_notify(df: DataFrame) -> DataFrame:
    """Rows that trigger a message: a named class other than benign."""
    label = canonical_attack(F.col("classe"))
    return df.filter((label != "") & (F.upper(label) != "BENIGN"))


def alert_message(df: DataFrame) -> DataFrame:
    """Add subject, body and the queue sentence of an alert."""
    name = F.coalesce(F.nullif(canonical_attack(F.col("classe")), F.lit("")), F.lit("Alerte inconnue"))
    severity = normalize_severity(F.col("gravite"))
    part = lambda title, c: F.concat(F.lit(f"{title} : "), text(F.col(c)))
    optional = lambda title, c: F.when(text(F.col(c)) != "", part(title, c))
    body = F.concat_ws(
        "\n",
        F.lit("Alerte de cybersecurite detectee"),
        F.concat(F.lit("Type d'attaque : "), name),
        F.concat(F.lit("Gravite : "), severity),
        part("Source de detection", "source"),
        part("Date/heure", "date"),
        part("Nombre", "nombre"),
        optional("IP source", "ip_source"),
        optional("IP destination", "ip_destination"),
        optional("Protocole", "protocole"),
        part("Action recommandee", "action_recommandee"),
    )
    return df.withColumns(
        {
            "subject": F.concat(F.lit("[SOC]["), severity, F.lit("] "), name),
            "body": body,
            "message": queue_sentence(),
        }
    )


def queue_sentence() -> Column:
    value = lambda c: text(F.col(c))
    known_ip = (value("ip_source") != "") | (value("ip_destination") != "")
    route = F.format_string(" IP source: %s. IP destination: %s.", value("ip_source"), value("ip_destination"))
    return F.concat(
        F.format_string(
            "Alerte %s detectee depuis %s: %s. Action recommandee: %s.",
            value("gravite"), value("source"), value("classe"), value("action_recommandee"),
        ),
        F.when(known_ip, route).otherwise(""),
    )


def priority_queue(df: DataFrame, tie: str = "event_id") -> DataFrame:
    """Open alerts of the two highest severities, most urgent and newest first, with their sentence."""
    queue = df.filter((F.col("statut") == K.OPEN) & F.col("gravite").isin("Critique", "Elevee"))
    ranked = queue.withColumns({"priorite": priority(F.col("gravite")), "message": queue_sentence()})
    return ranked.orderBy("priorite", F.col("date").desc(), F.col(tie))
