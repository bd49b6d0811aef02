"""Suffix-array dedup over bytes: a run-length index per shard.

A byte is removed if it lies in a string of 100 bytes that also starts earlier: in a text with a smaller id, or at a
smaller place of the same text. Each shard holds snippets around shared anchors (see long_repeats), and the runs of
their Burrows-Wheeler transform with each symbol's count at the runs' ends. Snippets are streamed through it for their
matching statistics; matches of 100 bytes and more at earlier places are marked.

Defined cases: null text has no bytes; a text under 100 bytes keeps all; rows with one id count as one text, in which
equal places aren't earlier than each other; a null id counts as the largest; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from .common import documents
from .long_repeats import BYTES, find_repeats, left_over, united


def finish(text: str, start: np.ndarray, end: np.ndarray) -> tuple:
    raw = text.encode()
    if not len(start):
        return len(raw), 0, 0, hashlib.sha256(raw).hexdigest()
    starts, ends = united(len(raw), start, end)
    kept = hashlib.sha256()
    for a, b in left_over(len(raw), starts, ends):
        kept.update(memoryview(raw)[a:b])
    return len(raw), sum(ends) - sum(starts), len(starts), kept.hexdigest()


def op4_byte_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_repeats(BYTES, documents(spark, sf_dir, "doc_id", "text"), finish, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def brute(rows: list[tuple[int, str]], size: int = 100) -> dict[int, tuple]:
    """The same by looking at every string; tests compare with it."""
    first: dict[bytes, tuple[int, int]] = {}
    out = {}
    for i, text in sorted(rows):
        raw = (text or "").encode()
        hits = []
        for k in range(len(raw) - size + 1):
            if first.setdefault(raw[k : k + size], (i, k)) != (i, k):
                hits.append(k)
        out[i] = finish(text or "", np.array(hits, int), np.array(hits, int) + size)
    return out


QUERIES = {"op4_byte_dedup": op4_byte_dedup}
SQL = {
    "op4_byte_dedup": r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
u AS (SELECT doc_id, unnest(regexp_extract_all(x, '..')) AS b, unnest(range(length(x) // 2)) AS i FROM d),
s AS (SELECT doc_id, i, b, string_agg(b, '') OVER f AS win, count(*) OVER f AS n FROM u WINDOW f AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 99 FOLLOWING)),
h AS (SELECT doc_id, i, b, CASE WHEN n = 100 THEN md5_number(win) END AS h FROM s),
m AS (SELECT h, min(doc_id * 1000000000::HUGEINT + i) AS least FROM h WHERE h IS NOT NULL GROUP BY h),
g AS (SELECT doc_id, i, b, coalesce(least < doc_id * 1000000000::HUGEINT + i, false) AS late FROM h LEFT JOIN m ON m.h = h.h),
c AS (SELECT doc_id, i, b, bool_or(late) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 99 PRECEDING AND CURRENT ROW) AS gone FROM g),
e AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY i), false) AS opens FROM c),
k AS (SELECT doc_id, count(*) FILTER (gone) AS n_removed, count(*) FILTER (opens) AS n_spans, string_agg(b, '' ORDER BY i) FILTER (NOT gone) AS kept FROM e GROUP BY doc_id)
SELECT d.doc_id, (length(x) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256 FROM d LEFT JOIN k USING (doc_id)
"""
}
