"""Substring dedup over words: a compressed FM-index per shard.

A window of 50 consecutive words is removed if it also starts in a text with a smaller id. Each shard holds snippets
around shared anchors (see long_repeats), and an FM-index over them: the Burrows-Wheeler transform in a wavelet matrix.
Snippets are streamed through it by backward search; their matching statistics, restricted to smaller ids, give the
intervals of 50 words and more.

Defined cases: null text has no words; a text under 50 words keeps all; rows with one id aren't earlier than each
other, and share what is removed from either; a null id counts as the largest; an empty table gives an empty result;
other columns are ignored. Words are compared by 32-bit names within snippets that share a 64-bit anchor.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from .common import documents
from .long_repeats import WORDS, find_repeats, left_over, united

_words = re.compile(r"[^\x20\x09-\x0D]+").findall


def finish(text: str, start: np.ndarray, end: np.ndarray) -> tuple:
    words = _words(text)
    if len(start):
        starts, ends = united(len(words), start, end)
        kept = " ".join(w for a, b in left_over(len(words), starts, ends) for w in words[a:b])
        return len(words), sum(ends) - sum(starts), hashlib.sha256(kept.encode()).hexdigest()
    return len(words), 0, hashlib.sha256(" ".join(words).encode()).hexdigest()


def op6_word_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_repeats(WORDS, documents(spark, sf_dir, "doc_id", "text"), finish, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def brute(rows: list[tuple[int, str]], size: int = 50) -> dict[int, tuple]:
    """The same by looking at every window; tests compare with it."""
    least: dict[tuple, int] = {}
    split = {i: _words(t or "") for i, t in rows}
    for i, words in split.items():
        for k in range(len(words) - size + 1):
            w = tuple(words[k : k + size])
            least[w] = min(least.get(w, i), i)
    out = {}
    for i, words in split.items():
        hits = [k for k in range(len(words) - size + 1) if least[tuple(words[k : k + size])] < i]
        out[i] = finish(" ".join(words), np.array(hits, int), np.array(hits, int) + size)
    return out


QUERIES = {"op6_word_dedup": op6_word_dedup}
SQL = {
    "op6_word_dedup": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
u AS (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS i FROM d),
s AS (SELECT doc_id, i, word, string_agg(word, ' ') OVER f AS win, count(*) OVER f AS n FROM u WINDOW f AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 49 FOLLOWING)),
h AS (SELECT doc_id, i, word, CASE WHEN n = 50 THEN md5(win) END AS h FROM s),
m AS (SELECT h, min(doc_id) AS least FROM h WHERE h IS NOT NULL GROUP BY h),
g AS (SELECT h.doc_id, i, word, coalesce(least < h.doc_id, false) AS late FROM h LEFT JOIN m ON m.h = h.h),
c AS (SELECT doc_id, i, word, bool_or(late) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone FROM g),
k AS (SELECT doc_id, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS kept FROM c GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN k USING (doc_id)
"""
}
