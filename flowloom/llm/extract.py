"""Main text of web pages: blocks, labelled by a recurrent network, joined in page order."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .html_blocks import blocks
from .labeller import Features, Labeller, trained

PAGES_AT_ONCE = 1000


def _extractor(sent):
    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network, features = sent.value, Features()
        for whole in batches:
            for at in range(0, len(whole), PAGES_AT_ONCE):
                batch = whole.slice(at, PAGES_AT_ONCE)
                found = [blocks(page) for page in batch.column(2).to_pylist()]
                main = network.predict([features.page(b) for b in found])
                texts = ["\n".join(b.text for b, m in zip(bs, ms, strict=True) if m) for bs, ms in zip(found, main, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64()), pa.array(map(len, found), pa.int64())], ["page_id", "url", "text", "n_chars", "n_blocks"]
                )

    return extract


def extract_text(pages: DataFrame, network: Labeller | None = None) -> DataFrame:
    """``page_id``, ``url``, ``text``, ``n_chars``, ``n_blocks`` of each row of ``pages``.

    ``text`` holds the blocks of main text, one a line; it is empty for a null or empty page and for one
    without main text. Broken markup is read as far as it goes. Rows that repeat are read each, other
    columns are not looked at, an empty table gives no rows.
    """
    rows = pages.select("page_id", "url", F.col("html").cast("string"))
    sent = pages.sparkSession.sparkContext.broadcast(network or trained())
    kinds = dict(rows.dtypes)
    return rows.mapInArrow(_extractor(sent), f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long, n_blocks long")
