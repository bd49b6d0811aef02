"""Secret scanning through an incremental blob ledger.

Texts are content-addressed: every historical version of every path is a blob named by its SHA-256. A ledger's entries
say which rules, at which versions, a blob was scanned with, and what they found; only blobs with rule versions outside
it are scanned, with the rules that they lack, and the findings are joined back to all paths that hold the blob.

A text is scanned where it lies: that costs less than moving it to where its copies are. A task scans a blob once; which
blobs can be in the ledger is told by a bitmap of fixed size, and only texts that it marks are joined with the ledger.

Defined cases: null text is the empty blob; a null id is a path like any other; repeated rows each get their row; an
empty table gives an empty result; other columns are ignored, or kept by redact(), whatever their names.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, marked_slots, materialise, sha_hex, shared_path, slices

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")  # a run too short for the limit holds no longer one
_HEX = re.compile(r"[0-9a-f]{16,}")
_PEM = re.compile(r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----")
#: Behind a BEGIN line: header lines, then lines of base64, as far as they go.
_BODY = re.compile(r"(?:[ \t]*\r?\n(?:[A-Za-z-]+: [^\r\n]*)?)*(?:\s*[A-Za-z0-9+/=]{16,})*(?:\s*[A-Za-z0-9+/]+={1,2})?")
_JWT = re.compile(r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}")
#: Tokens of services, which begin alike.
_GITHUB = re.compile(r"gh[pousr]_[A-Za-z0-9]{36,}")
_SLACK = re.compile(r"xox[abprs]-[A-Za-z0-9-]{10,}")
_GOOGLE = re.compile(r"AIza[A-Za-z0-9_-]{35}")
_STRIPE = re.compile(r"sk_live_[A-Za-z0-9]{24,}")
#: Blobs of the ledger are marked in so many bits, by a hash.
SLOTS = 1 << 22
#: Blobs that a task remembers to have scanned.
REMEMBERED = 1 << 16


def _assign(text: str) -> Iterator[tuple[int, int]]:
    if ":" in text or "=" in text:
        for m in _ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= 12:
                yield m.span()


def _spans(pattern: re.Pattern, needle: str = "") -> Callable[[str], Iterator[tuple[int, int]]]:
    def find(text: str) -> Iterator[tuple[int, int]]:
        return (m.span() for m in pattern.finditer(text)) if needle in text else iter(())

    return find


#: kind -> (version, finder), in the order that breaks ties of start; the first three are the base.
RULES: dict[str, tuple[int, Callable]] = {
    "assign": (1, _assign),
    "access": (1, _spans(_ACCESS, "AKIA")),
    "hex": (1, _spans(_HEX)),
    "pem": (1, _spans(_PEM, "-----BEGIN")),
    "jwt": (1, _spans(_JWT, "eyJ")),
    "github": (1, _spans(_GITHUB, "gh")),
    "slack": (1, _spans(_SLACK, "xox")),
    "google": (1, _spans(_GOOGLE, "AIza")),
    "stripe": (1, _spans(_STRIPE, "sk_live_")),
}
BASE = ("assign", "access", "hex")
FOUND = "array<struct<kind:string,start:long,end:long>>"
#: An entry of the ledger: a blob, the rules that it was scanned with, their versions, what they found.
LEDGER = f"blob string, rules array<string>, versions array<int>, findings {FOUND}"
_FOUND = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def scan_text(text: str, rules: list[str] | None = None) -> list[tuple[str, int, int]]:
    """(kind, start, end) of all findings in code points, by start, then by the order of the rules."""
    found = [(start, n, end, kind) for n, kind in enumerate(RULES) if rules is None or kind in rules for start, end in RULES[kind][1](text)]
    return [(kind, start, end) for start, _, end, kind in sorted(found)]


def _slot(blob: Column) -> Column:
    return F.pmod(F.xxhash64(blob), F.lit(SLOTS)).cast("int")


def current(ledger: DataFrame) -> DataFrame:
    """A row a blob: known (rules scanned at their present versions), findings (theirs, in order)."""
    versions = F.create_map(*(F.lit(x) for k, (v, _) in RULES.items() for x in (k, v)))
    order = F.create_map(*(F.lit(x) for n, k in enumerate(RULES) for x in (k, n)))
    fresh = F.filter("rules", lambda r: F.element_at(F.map_from_arrays("rules", "versions"), r).eqNullSafe(F.element_at(versions, r)))
    entries = ledger.select("blob", fresh.alias("known"), "findings").withColumn("findings", F.filter("findings", lambda f: F.array_contains("known", f["kind"])))
    every = entries.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("known"))).alias("known"), F.array_distinct(F.flatten(F.collect_list("findings"))).alias("findings"))
    keyed = F.transform("findings", lambda f: F.struct(f["start"].alias("start"), F.element_at(order, f["kind"]).alias("n"), f["kind"].alias("kind"), f["end"].alias("end")))
    return every.withColumn("findings", F.transform(F.array_sort(keyed), lambda f: F.struct(f["kind"].alias("kind"), f["start"].alias("start"), f["end"].alias("end"))))


def _scan_rows(rows: DataFrame, skip: np.ndarray | None = None) -> DataFrame:
    """rows (doc_id, blob, rules, slot, text) -> doc_id, blob, rules, findings; the last two only where a blob is scanned.
    skip: slots whose rows are left out."""
    shipped = rows.sparkSession.sparkContext.broadcast(None if skip is None else np.packbits(skip))  # SLOTS bits

    def run(batches):
        marks = None if shipped.value is None else np.unpackbits(shipped.value).astype(bool)
        done: set[str] = set()
        for batch in slices(batches):
            if marks is not None:
                batch = batch.filter(pa.array(~marks[batch.column(3).to_numpy()]))
            blobs, rules, found = batch.column(1).to_pylist(), batch.column(2).to_pylist(), []
            for i, (blob, text) in enumerate(zip(blobs, batch.column(4).to_pylist())):
                if blob in done or not rules[i]:
                    rules[i] = None
                    found.append(None)
                    continue
                if len(done) >= REMEMBERED:
                    done.clear()
                done.add(blob)
                found.append([{"kind": k, "start": s, "end": e} for k, s, e in scan_text(text or "", rules[i])])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(rules, pa.list_(pa.string())), pa.array(found, _FOUND)], ["doc_id", "blob", "rules", "findings"])

    return rows.mapInArrow(run, f"doc_id long, blob string, rules array<string>, findings {FOUND}")


def scan(docs: DataFrame, ledger: DataFrame | None = None) -> DataFrame:
    """A row a path: doc_id, blob; and rules and findings, where its blob was scanned here, with the rules that the ledger
    lacked. A blob that tasks met at once can have several such rows."""
    rules = F.array(*(F.lit(k) for k in RULES))
    named = docs.select("doc_id", sha_hex().alias("blob"), "text").select("doc_id", "blob", rules.alias("rules"), _slot(F.col("blob")).alias("slot"), "text")
    if ledger is None:
        return _scan_rows(named)
    known = current(ledger).select(F.col("blob").alias("_blob"), "known")
    marks = marked_slots(ledger.select(_slot(F.col("blob")).alias("slot")), SLOTS)
    shipped = docs.sparkSession.sparkContext.broadcast(np.packbits(marks))  # SLOTS bits

    def only_marked(batches):
        here = np.unpackbits(shipped.value).astype(bool)
        for batch in batches:
            yield batch.filter(pa.array(here[batch.column(3).to_numpy()]))

    maybe = named.mapInArrow(only_marked, named.schema)
    # of a blob that needs nothing, no text is wanted
    rest = maybe.join(known, maybe["blob"] == known["_blob"], "left").withColumn("rules", F.array_except(rules, F.coalesce("known", F.array().cast("array<string>"))))
    rest = rest.select("doc_id", "blob", "rules", "slot", F.when(F.size("rules") > 0, F.col("text")).alias("text"))
    return _scan_rows(named, marks).unionByName(_scan_rows(rest))


def entries(scanned: DataFrame) -> DataFrame:
    """What a scan adds to the ledger."""
    versions = F.create_map(*(F.lit(x) for k, (v, _) in RULES.items() for x in (k, v)))
    once = scanned.filter("rules is not null").groupBy("blob").agg(F.max(F.struct("rules", "findings")).alias("e"))
    return once.select("blob", "e.rules", F.transform("e.rules", lambda r: F.element_at(versions, r)).alias("versions"), "e.findings")


def findings_by_path(paths: DataFrame, ledger: DataFrame) -> DataFrame:
    """paths (doc_id, blob) -> doc_id, blob, findings of its blob, null if there are none. Both sides are dealt as they
    are stored, so that the paths of a blob that many hold can be split among tasks."""
    hits = materialise(current(ledger).filter(F.size("findings") > 0).select(F.col("blob").alias("_blob"), "findings"))
    return paths.join(hits, paths["blob"] == hits["_blob"], "left").drop("_blob")


def scan_with_ledger(docs: DataFrame, path: str) -> DataFrame:
    """Brings the ledger kept in a folder up to date with docs, and gives every path's findings: doc_id, blob, findings."""
    spark = docs.sparkSession
    try:
        ledger = spark.read.schema(LEDGER).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        ledger = None
    scanned = materialise(scan(docs, ledger))
    entries(scanned).write.mode("append").parquet(path)
    return findings_by_path(scanned.select("doc_id", "blob"), spark.read.schema(LEDGER).parquet(path))


def redact_text(text: str, spans: list[tuple[int, int]], mask: str = "<SECRET>") -> str:
    """Each stretch that spans cover, overlapping ones as one, becomes the mask."""
    out, at, reach = [], 0, -1
    for start, end in sorted(spans):
        if start > reach:
            out += [text[at:start], mask]
        at = reach = max(reach, end)
    return "".join([*out, text[at:]])


def key_end(text: str, start: int, end: int) -> int:
    """Where the key ends whose BEGIN line is text[start:end]: behind its END line, or behind its lines of base64."""
    closing = text[start:end].replace("BEGIN", "END")
    stop, again = text.find(closing, end), text.find("-----BEGIN", end)
    if stop >= 0 and (again < 0 or stop < again):
        return stop + len(closing)
    return _BODY.match(text, end).end()


def masked_spans(text: str, findings: list[dict]) -> list[tuple[int, int]]:
    """What is masked for a text's findings: the whole key where a finding is its BEGIN line."""
    return [(x["start"], key_end(text, x["start"], x["end"]) if x["kind"] == "pem" else x["end"]) for x in findings]


def redact(docs: DataFrame) -> DataFrame:
    """docs with its columns: secrets masked in text, n_chars brought up to date; all rows stay, and none moves. A text is
    masked where it is scanned; equal texts that a task meets are scanned once."""
    names, at = docs.columns, docs.columns.index("text")

    def run(batches):
        known: dict[bytes, list] = {}
        for batch in slices(batches):
            texts, changed = batch.column(at).to_pylist(), False
            for i, text in enumerate(texts):
                if not text:
                    continue
                blob = hashlib.sha256(text.encode()).digest()
                spans = known.get(blob)
                if spans is None:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    spans = known[blob] = masked_spans(text, [{"kind": k, "start": a, "end": b} for k, a, b in scan_text(text)])
                if spans:
                    texts[i], changed = redact_text(text, spans), True
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if i == at else batch.column(i) for i in range(len(names))], names) if changed else batch

    out = docs.mapInArrow(run, docs.schema)
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in names else out


def op7_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = F.coalesce("findings", F.array().cast(FOUND))
    of = lambda kind: F.size(F.filter("f", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    words = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    base = F.filter("f", lambda x: x["kind"].isin(*BASE))
    joined = scan_with_ledger(documents(spark, sf_dir, "doc_id", "text"), shared_path(spark)).select("doc_id", found.alias("f"))
    return joined.select("doc_id", *(of(k) for k in BASE), F.sha2(words(base), 256).alias("base_sha256"), words(F.col("f")).alias("spans"))


def digest(text: str | None) -> tuple[int, int, int, str, str]:
    """What the query returns for one text, by plain scanning; tests compare with it."""
    spans = scan_text(text or "")
    base = [s for s in spans if s[0] in BASE]
    join = lambda x: ",".join(f"{k}:{a}:{b}" for k, a, b in x)
    return (*(sum(s[0] == k for s in base) for k in BASE), hashlib.sha256(join(base).encode()).hexdigest(), join(spans))


QUERIES = {"op7_secret_ledger": op7_secret_ledger}


def _sql_rule(kind: str, pattern: str, place: int, group: int = 0, least: int = 0) -> str:
    """Matches and the pieces between them give the places of the matches."""
    quoted = pattern.replace("'", "''")
    return f"""SELECT doc_id, '{kind}' AS kind, {place} AS k, list_transform(range(1, len(m) + 1), lambda i: {{'s': list_sum(list_transform(p[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0), 'n': length(m[i]), 'g': length(g[i])}}) AS f, {least} AS least
FROM (SELECT doc_id, regexp_extract_all(t, '{quoted}') AS m, regexp_split_to_array(t, '{quoted}') AS p, regexp_extract_all(t, '{quoted}', {group}) AS g FROM d)"""


_SQL_RULES = (
    ("assign", r"""(?i:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?)([A-Za-z0-9+/_.=-]+)""", 2, 12),
    ("access", r"AKIA[A-Z0-9]+", 0, 18),
    ("hex", r"[0-9a-f]+", 0, 16),
    ("pem", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----", 0, 0),
    ("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 0),
    ("github", r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 0),
    ("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 0),
    ("google", r"AIza[A-Za-z0-9_-]{35}", 0, 0),
    ("stripe", r"sk_live_[A-Za-z0-9]{24,}", 0, 0),
)
SQL = {
    "op7_secret_ledger": f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
r AS ({" UNION ALL ".join(_sql_rule(kind, pattern, place, group, least) for place, (kind, pattern, group, least) in enumerate(_SQL_RULES))}),
u AS (SELECT doc_id, kind, k, least, unnest(f) AS f FROM r),
x AS (SELECT doc_id, kind, k, f.s AS a, kind || ':' || f.s::BIGINT || ':' || (f.s + f.n)::BIGINT AS span FROM u WHERE f.g >= least)
SELECT d.doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
sha256(coalesce(string_agg(span, ',' ORDER BY a, k) FILTER (k < 3), '')) AS base_sha256, coalesce(string_agg(span, ',' ORDER BY a, k), '') AS spans
FROM d LEFT JOIN x USING (doc_id) GROUP BY d.doc_id
"""
}
