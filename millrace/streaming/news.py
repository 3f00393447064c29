"""Change detection of news pages on a stream (W1): the state of every page lives in the state store.

Rows come with seq, url, confidence, is_fresh_24h, content_hash. Within a micro-batch a page's rows are taken by ``seq``;
the verdicts and the registered hash are those of the batch operator ``gate_news``.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OUT = "seq long, url string, verdict string"


def judge(key: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
    last = state.get[0] if state.exists else None
    rows = pd.concat(list(batches)).sort_values("seq")
    verdicts = []
    for confidence, fresh, digest in zip(rows["confidence"], rows["is_fresh_24h"], rows["content_hash"]):
        if confidence != "none":
            said = "kept" if fresh is True or fresh == 1 else "stale"
        else:
            said = "kept" if digest != last else "duplicate"
        if said != "stale":
            last = digest
        verdicts.append(said)
    if last is not None:
        state.update((last,))
    yield pd.DataFrame({"seq": rows["seq"], "url": key[0], "verdict": verdicts})


def stream_verdicts(dated: DataFrame) -> DataFrame:
    """A stream of (seq, url, verdict) from a stream of dated rows."""
    rows = dated.select("seq", "url", F.col("date.confidence").alias("confidence"), F.col("date.is_fresh_24h").alias("is_fresh_24h"), "content_hash")
    return rows.groupBy("url").applyInPandasWithState(judge, OUT, "content_hash string", "append", "NoTimeout")
