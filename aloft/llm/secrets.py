"""Operator 6: secret scans over an incremental blob ledger.

Every text is addressed by its content (SHA-256).  The ledger is a Parquet table with one row
per blob and rule version that has been scanned: its findings, or none.  An update
scans only those blobs that the ledger lacks for the present rule version, appends their
rows, and findings are joined back to every path (row) that holds the blob.  Copies, also
a third of all rows, are dropped in each input task before the shuffle and again after it,
so each new blob is scanned once.

Offsets are code points, the end exclusive.  A null text is the empty blob (no findings);
repeated rows and null ids each get their own result row; an empty table gives none.  A very long text is
held and scanned whole by its task.
"""

from __future__ import annotations

import hashlib
import re
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aloft.llm.common import columns_of, fresh, ship, shuffle_partitions, text_batches
from aloft.session import require_checkpoint_dir

RULES_VERSION = "1.1"
#: in this order where two findings start at the same place
KINDS = ["assign", "access", "hex", "pem", "jwt", "url_login"]
BASE_KINDS = KINDS[:3]
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                     r"([A-Za-z0-9+/_.=-]+)", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")  # the maximal runs of 24 or more
# up to the END line; without one, header lines and long base64 words, with a last short line
_PEM = re.compile(
    r"-----BEGIN [A-Z ]*PRIVATE KEY-----(?:"
    r"(?:[^-]|-(?!----))*+-----END [A-Z ]*PRIVATE KEY-----"
    r"|(?:(?:\s|\\[nrt])*+(?:[A-Za-z][A-Za-z0-9-]*+:[^\r\n]*+[\r\n]\s*+)*+"
    r"(?:[A-Za-z0-9+/]{24,}+={0,2}(?:\s|\\[nrt])*+)++"
    r"(?:(?<=[\r\n])[A-Za-z0-9+/]{1,23}+={0,2}(?=[^\S\r\n]*(?:[\r\n]|\Z)))?)?)")
_JWT = re.compile(r"\beyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]+")
_URL = re.compile(r"[a-z][a-z0-9+.-]*://[^\s/:@]+:[^\s/@]+@", re.A)


def scan(text: str) -> list[tuple[str, int, int]]:
    """All findings (kind, start, end) by start, then by the order of ``KINDS``."""
    out = []
    low = text.lower()
    if ("=" in text or ":" in text) and any(k in low for k in ("passw", "secret", "token", "api")):
        out += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [("access", *m.span()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [("hex", *m.span()) for m in _HEX.finditer(text)]
    if "-----BEGIN " in text:
        out += [("pem", *m.span()) for m in _PEM.finditer(text)]
    if "eyJ" in text:
        out += [("jwt", *m.span()) for m in _JWT.finditer(text)]
    if "://" in text and "@" in text:
        out += [("url_login", *m.span()) for m in _URL.finditer(text)]
    return sorted(out, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


LEDGER_SCHEMA = ("blob binary, rules string, "
                 "spans array<struct<kind:string,start:int,stop:int>>")


def blob_address(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


class BlobLedger:
    """Findings by content, kept at ``path`` (a folder that all executors share)."""

    def __init__(self, spark: SparkSession, path: str, rules: str = RULES_VERSION):
        self.spark, self.path, self.rules = spark, path, rules

    def rows(self) -> DataFrame:
        """What the ledger holds for its rule version; empty if it was never written."""
        from pyspark.errors import AnalysisException
        try:
            held = self.spark.read.schema(LEDGER_SCHEMA).parquet(self.path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], LEDGER_SCHEMA)
        return held.where(F.col("rules") == self.rules)

    def update(self, docs: DataFrame, text_col: str = "text") -> None:
        """Scan the blobs of ``docs`` that the ledger lacks and append their findings."""
        ship(self.spark)
        rules = self.rules

        def first_of(batches, address):
            seen = set()
            for batch in batches:
                blobs = address(batch)
                take = []
                for i, b in enumerate(blobs):
                    if b not in seen:
                        seen.add(b)
                        take.append(i)
                if take:
                    yield batch.take(pa.array(take, pa.int64())), [blobs[i] for i in take]

        def distinct_in_task(batches):
            def address(batch):
                return [hashlib.sha256((t or "").encode()).digest()
                        for t in batch.column(0).to_pylist()]
            for batch, blobs in first_of(text_batches(batches, "text"), address):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(blobs, pa.binary()), batch.column(0)], names=["blob", "text"])

        def scan_once(batches):
            for batch, blobs in first_of(text_batches(batches, "text"),
                                         lambda b: b.column(0).to_pylist()):
                spans = [[{"kind": k, "start": s, "stop": e} for k, s, e in scan(t or "")]
                         for t in batch.column(1).to_pylist()]
                kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()),
                                           ("stop", pa.int32())]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(blobs, pa.binary()), pa.array([rules] * len(blobs), pa.string()),
                     pa.array(spans, kind)], names=["blob", "rules", "spans"])

        blobs = (docs.select(F.col(text_col).alias("text"))
                 .mapInArrow(distinct_in_task, "blob binary, text string"))
        unseen = blobs.join(self.rows().select("blob"), "blob", "left_anti")
        (unseen.repartition(shuffle_partitions(self.spark), "blob")
         .mapInArrow(scan_once, LEDGER_SCHEMA)
         .write.mode("append").parquet(self.path))

    def findings(self, docs: DataFrame, text_col: str = "text", spans_col: str = "__spans") -> DataFrame:
        """``docs`` with column ``spans_col`` (null where nothing was found).  A blob that two updates at
        once have written counts once."""
        blob, address = fresh(docs, "__blob"), fresh(docs, "__address")
        held = (self.rows().where(F.size("spans") > 0).dropDuplicates(["blob"])
                .select(F.col("blob").alias(blob), F.col("spans").alias(spans_col)))
        return (docs.withColumn(address, blob_address(F.col(text_col)))
                .join(held, F.col(address) == F.col(blob), "left").drop(address, blob))


def new_ledger(spark: SparkSession) -> BlobLedger:
    """A ledger in a fresh folder under ``spark.checkpoint.dir``."""
    return BlobLedger(spark, f"{require_checkpoint_dir(spark)}/secret-ledger-{uuid.uuid4().hex}")


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def find_secrets(docs: DataFrame, ledger: BlobLedger | None = None, *, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """One row per row: id, n_assign, n_access, n_hex, base_sha256, spans."""
    ledger = ledger or new_ledger(docs.sparkSession)
    ledger.update(docs, text_col)
    src = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
    # addresses alone are joined: the texts stay where they were read
    found = (ledger.findings(src, "__text")
             .select("__id", F.coalesce("__spans", F.array()).alias("__spans")))
    count = lambda kind: F.size(F.filter("__spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("__spans", lambda s: s["kind"].isin(*BASE_KINDS))
    return found.select(
        F.col("__id").alias(id_col), count("assign").alias("n_assign"),
        count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("__spans")).alias("spans"))


def redact(docs: DataFrame, ledger: BlobLedger | None = None, *, text_col: str = "text",
           length_col: str | None = None, mask: str = "[SECRET]") -> DataFrame:
    """``docs`` with each finding in ``text_col`` replaced by ``mask`` (overlapping findings by
    one) and ``length_col``, if given, set to the new length; other rows and columns
    are unchanged."""
    ledger = ledger or new_ledger(docs.sparkSession)
    ledger.update(docs, text_col)

    @F.pandas_udf("string")
    def masked(text, spans):
        import pandas as pd

        def one(t, found):
            out, at, end = [], 0, -1
            for s in found:
                if s["start"] > end or end < 0:
                    out += [t[at:s["start"]], mask]
                    end = s["stop"]
                else:
                    end = max(end, s["stop"])
                at = end
            return "".join(out) + t[at:]
        return pd.Series([None if t is None else one(t, f) for t, f in zip(text, spans)])

    spans = fresh(docs, "__spans")
    found = ledger.findings(docs, text_col, spans)
    hit = F.col(spans).isNotNull()
    # texts without findings stay in the JVM
    new = {text_col: F.coalesce(masked(F.when(hit, F.col(text_col)), F.col(spans)), F.col(text_col))}
    found = found.withColumns(new)
    if length_col:
        kind = docs.schema[length_col].dataType
        found = found.withColumn(length_col, F.when(hit, F.length(text_col).cast(kind)).otherwise(F.col(length_col)))
    return found.select(columns_of(docs))
