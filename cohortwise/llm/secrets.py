"""Secret scans with a ledger of contents already scanned.

Every version of a file is addressed by the SHA-256 of its content. Only pairs of
content and rule version that the ledger lacks are scanned, each once, and the
findings are joined back to every path and version with that content.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from cohortwise.llm.common import Workspace

FINDING = "array<struct<start:bigint,end:bigint,kind:string>>"
LEDGER = f"blob binary, rule string, rule_version int, findings {FINDING}"
SCANNED = f"blob binary, results array<struct<rule:string,rule_version:int,findings:{FINDING}>>"

# The base patterns.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
# Hexadecimal digits to x, all else to a blank: a long run is then found fast.
HEX_TABLE = bytes(120 if chr(i) in "0123456789abcdef" else 32 for i in range(256))


def find_assign(text: str, data: bytes) -> list[tuple[int, int]]:
    low = data.lower()
    if not any(w.encode() in low for w in ASSIGN_WORDS):
        return []
    return [m.span() for m in ASSIGN.finditer(text) if len(m[2]) >= 6]


def find_access(text: str, data: bytes) -> list[tuple[int, int]]:
    return [m.span() for m in ACCESS.finditer(text) if len(m[0]) >= 20] if b"AKIA" in data else []


def find_hex(text: str, data: bytes) -> list[tuple[int, int]]:
    """A run of 24 or more: leftmost runs are maximal, so shorter ones can be passed over."""
    return [m.span() for m in HEX.finditer(text)] if b"x" * 24 in data.translate(HEX_TABLE) else []


@dataclass(frozen=True)
class Rule:
    """A kind of secret. A new ``version`` makes all contents unseen again."""

    kind: str
    version: int
    find: Callable[[str, bytes], list[tuple[int, int]]]


BASE_RULES = (Rule("assign", 1, find_assign), Rule("access", 1, find_access), Rule("hex", 1, find_hex))


def _scanner(rules: Sequence[Rule]):
    item = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())])
    result = pa.struct([("rule", pa.string()), ("rule_version", pa.int32()), ("findings", pa.list_(item))])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {r.kind: r for r in rules}
        for batch in batches:
            results = []
            for text, todo in zip(batch.column(1), batch.column(2)):
                text = text.as_py()
                data, found = text.encode(), []
                for kind in todo.as_py():
                    spans = [{"start": a, "end": b, "kind": kind} for a, b in kinds[kind].find(text, data)]
                    found.append({"rule": kind, "rule_version": kinds[kind].version, "findings": spans})
                results.append(found)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(results, pa.list_(result))], ["blob", "results"]
            )

    return scan


def scan_versions(
    versions: DataFrame,
    keys: Sequence[str],
    text: str = "text",
    ledger: DataFrame | None = None,
    rules: Sequence[Rule] = BASE_RULES,
    work: Workspace | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Findings of every version, and the ledger's new rows.

    ``versions`` has one row per historical version; ``keys`` are its columns
    that name path and version. Gives ``(*keys, blob, findings)`` with the
    findings by start and then in the order of the rules, and new ledger rows
    ``(blob, rule, rule_version, findings)``, to be appended to the ledger.

    Only one row per content and only its unseen rules are scanned. A null text
    is an empty one. Rows whose keys repeat stay rows of their own, also with
    different texts. Null keys are kept. Other columns are not read.
    """
    spark = versions.sparkSession
    work = work or Workspace(spark, "secrets")
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    names = [f"_k{i}" for i in range(len(keys))]
    paths = versions.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], body.alias("_text"))
    paths = paths.withColumn("blob", F.unhex(F.sha2("_text", 256)))
    index = work.stored(paths.drop("_text"), "index")
    wanted = spark.createDataFrame([(r.kind, r.version) for r in rules], "rule string, rule_version int")
    first = F.struct(*[F.col(n) for n in names])
    blobs = index.groupBy("blob").agg(F.min(first).alias("_first"))
    each = F.array(*[F.struct(F.lit(r.kind).alias("rule"), F.lit(r.version).alias("rule_version")) for r in rules])
    pairs = blobs.select("blob", "_first", F.inline(each))
    if ledger is not None:
        pairs = pairs.join(ledger.select("blob", "rule", "rule_version"), ["blob", "rule", "rule_version"], "left_anti")
    order = {r.kind: i for i, r in enumerate(rules)}
    unseen = pairs.groupBy("blob", "_first").agg(F.sort_array(F.collect_set("rule")).alias("_todo"))
    unseen = unseen.select("blob", "_todo", *[F.col("_first")[n].alias(n) for n in names])
    # The key finds the one row to be read; the content address keeps rows of equal keys apart.
    same = F.lit(True)
    for n in [*names, "blob"]:
        same = same & paths[n].eqNullSafe(unseen[n])
    texts = paths.join(unseen, same).select(unseen["blob"], paths["_text"], unseen["_todo"])
    scanned = texts.mapInArrow(_scanner(rules), SCANNED).dropDuplicates(["blob"])
    fresh = work.stored(scanned.select("blob", F.inline("results")), "ledger")
    known = fresh if ledger is None else fresh.unionByName(ledger.select(*fresh.columns))
    known = known.join(F.broadcast(wanted), ["rule", "rule_version"], "left_semi").filter(F.size("findings") > 0)
    rank = F.create_map(*[F.lit(x) for pair in order.items() for x in pair])
    spans = known.select("blob", F.explode("findings").alias("f")).groupBy("blob")
    item = F.struct(F.col("f.start"), F.element_at(rank, F.col("f.kind")).alias("rank"), F.col("f.end"), F.col("f.kind"))
    spans = spans.agg(F.array_sort(F.collect_list(item)).alias("findings"))
    found = index.join(spans, "blob", "left").select(
        *[F.col(n).alias(k) for k, n in zip(keys, names)],
        "blob",
        F.coalesce("findings", F.array().cast(spans.schema["findings"].dataType)).alias("findings"),
    )
    return found, fresh


def span_text(findings: Column) -> Column:
    parts = F.transform(findings, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    return F.array_join(parts, ",")
