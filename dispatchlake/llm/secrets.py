"""Secret scan with corpus-wide ownership frequency.

One pass finds, in whole texts, the base spans (assignments, access keys, hexadecimal runs) and candidate
tokens that look random. Candidate values are hashed and counted over the corpus by distinct owner and
distinct repository: a value that several owners or very many repositories hold is a widely copied example, any other is
live-looking and becomes a span of kind ``owned``. Base spans stay whatever their count is; how many spans
of a document are live-looking or copied is reported beside them.

Defined results: a null text is empty and has no spans; a null owner is an owner of its own; repeated rows
are separate documents, each with its own result; a null id is carried through; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from dispatchlake.llm.batches import lean
from dispatchlake.session import settle

KINDS = ("assign", "access", "hex", "owned")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
KEYWORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # a run is maximal, so this drops exactly the runs that are too short
RANDOM = re.compile(r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*[0-9])[A-Za-z0-9+/_=-]{20,}")
COPIED_OWNERS = 2  # owners that make a value a copied example
COPIED_REPOSITORIES = 25  # repositories that do, whoever owns them
MIN_BITS = 3.0  # Shannon entropy per character from which a token looks random

ROWS = pa.schema(
    [
        ("row_id", pa.int64()),
        ("doc_id", pa.int64()),
        ("owner", pa.string()),
        ("repository", pa.string()),
        ("n_assign", pa.int64()),
        ("n_access", pa.int64()),
        ("n_hex", pa.int64()),
        ("base_sha256", pa.string()),
        (
            "found",
            pa.list_(
                pa.struct(
                    [("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64()), ("value", pa.string())]
                )
            ),
        ),
    ]
)


def entropy(token: str) -> float:
    n = len(token)
    return -sum(c / n * math.log2(c / n) for c in Counter(token).values())


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind, end, secret value) of the base spans, by start and then by kind."""
    found = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        found += [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end(), m[0]) for m in HEX.finditer(text)]
    return sorted(found)


def random_tokens(text: str, base: list[tuple[int, int, int, str]]) -> list[tuple[int, int, int, str]]:
    """Random-looking tokens that touch no base span."""
    starts = [s for s, *_ in base]
    reach = list(accumulate((e for _, _, e, _ in base), max))  # the furthest end of the spans up to each
    found = []
    for m in RANDOM.finditer(text):
        before = bisect_left(starts, m.end())
        if entropy(m[0]) >= MIN_BITS and not (before and reach[before - 1] > m.start()):
            found.append((m.start(), 3, m.end(), m[0]))
    return found


def written(spans: list[tuple[int, int, int, str]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e, _ in spans)


def _hash(value: str) -> str:
    return hashlib.sha256(value.encode("utf-8", "surrogatepass")).hexdigest()


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    row = TaskContext.get().partitionId() << 33
    for batch in batches:
        rows = []
        for doc, text, owner, repository in zip(*(c.to_pylist() for c in batch.columns)):
            base = base_spans(text or "")
            found = base + random_tokens(text or "", base)
            rows.append(
                {
                    "row_id": row,
                    "doc_id": doc,
                    "owner": owner,
                    "repository": repository,
                    **{f"n_{n}": sum(k == i for _, k, _, _ in base) for i, n in enumerate(KINDS[:3])},
                    "base_sha256": hashlib.sha256(written(base).encode()).hexdigest(),
                    "found": [{"start": s, "kind": k, "end": e, "value": _hash(v)} for s, k, e, v in found],
                }
            )
            row += 1
        yield pa.RecordBatch.from_pylist(rows, schema=ROWS)


SCANNED = (
    "row_id long, doc_id long, owner string, repository string, n_assign long, n_access long, n_hex long, "
    "base_sha256 string, found array<struct<start:long,kind:int,end:long,value:string>>"
)


def is_live(copied_owners: int, copied_repositories: int) -> Column:
    """Held by few owners and in few repositories: nobody copies a credential widely that works."""
    return (F.col("n_owners") < copied_owners) & (F.col("n_repositories") < copied_repositories)


def ownership(found: DataFrame) -> DataFrame:
    """Distinct owners and repositories of every value. Each step combines map-side, so a hot value stays small."""
    pairs = found.groupBy("value", F.coalesce("owner", F.lit("")).alias("owner"), "repository").agg(
        F.count(F.lit(1)).alias("n")
    )
    owners = pairs.groupBy("value", "owner").agg(F.count(F.lit(1)).alias("repositories"))
    return owners.groupBy("value").agg(
        F.count(F.lit(1)).alias("n_owners"), F.sum("repositories").alias("n_repositories")
    )


def scan_secrets(
    docs: DataFrame,
    owner: str = "source",
    repository: str = "doc_id",
    copied_owners: int = COPIED_OWNERS,
    copied_repositories: int = COPIED_REPOSITORIES,
) -> DataFrame:
    """One row per document with its spans; so many owners, or repositories of one, make a value a copied example.

    Returns doc_id, n_assign, n_access, n_hex, base_sha256, ``found`` (all kept spans in order, as structs
    of start, kind, end and live), n_live and n_copied. Only documents with spans take part in the count.
    """
    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.col(owner).cast("string").alias("owner"),
        F.col(repository).cast("string").alias("repository"),
    )
    rows = settle(narrow.mapInArrow(lean(_scan), SCANNED), "secret-rows")
    found = rows.filter(F.size("found") > 0).select(
        "row_id", "owner", "repository", F.explode("found").alias("f")
    ).select("row_id", "owner", "repository", "f.*")
    judged = found.join(ownership(found), "value").withColumn("live", is_live(copied_owners, copied_repositories))
    spans = (
        judged.filter((F.col("kind") < 3) | F.col("live"))
        .groupBy("row_id")
        .agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end", "live"))).alias("spans"))
    )
    live = F.coalesce(F.size(F.filter("spans", lambda s: s["live"])), F.lit(0))
    total = F.coalesce(F.size("spans"), F.lit(0))
    plain = rows.drop("found", "owner", "repository")
    return plain.join(spans, "row_id", "left").select(
        "doc_id",
        "n_assign",
        "n_access",
        "n_hex",
        "base_sha256",
        F.coalesce("spans", F.array().cast("array<struct<start:long,kind:int,end:long,live:boolean>>")).alias("found"),
        F.when(F.col("spans").isNull(), F.lit(0)).otherwise(live).cast("long").alias("n_live"),
        F.when(F.col("spans").isNull(), F.lit(0)).otherwise(total - live).cast("long").alias("n_copied"),
    )


def span_text(found: str = "found"):
    """The spans of a scanned row as ``kind:start:end``, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(found, lambda s: F.concat_ws(":", F.element_at(kinds, s["kind"] + 1), s["start"], s["end"])), ","
    )


MASK = "[SECRET]"


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start < out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _masker(length: str | None):
    """Masks base spans and the random tokens whose hash is among a row's ``__live_values``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, lengths = [], batch.column(length).to_pylist() if length else []
            for row, (text, values) in enumerate(zip(batch.column("text"), batch.column("__live_values").to_pylist())):
                text = text.as_py()
                base = base_spans(text or "")
                spans = [(s, e) for s, _, e, _ in base]
                if values:
                    known = set(values)
                    spans += [(s, e) for s, _, e, v in random_tokens(text, base) if _hash(v) in known]
                if spans:
                    for s, e in reversed(_merged(spans)):
                        text = text[:s] + MASK + text[e:]
                    if length:
                        lengths[row] = len(text)
                texts.append(text)
            columns = {n: batch.column(n) for n in batch.schema.names if n != "__live_values"}
            if length:
                columns[length] = pa.array(lengths, columns[length].type)
            columns["text"] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return run


def _values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every value that a document holds, and whether a random token of it has the value."""
    for batch in batches:
        rows = []
        others = zip(*(batch.column(c).to_pylist() for c in ("holder", "owner", "repository")))
        for text, (holder, owner, repository) in zip(batch.column("text"), others):
            text = text.as_py() or ""
            base = base_spans(text)
            new = {_hash(v) for *_, v in random_tokens(text, base)}
            held = new.union(_hash(v) for *_, v in base)
            rows += [(holder, v, owner, repository, v in new) for v in sorted(held)]
        types = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.bool_()]
        columns = zip(*rows) if rows else [()] * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types)], names=["holder", "value", "owner", "repository", "random"]
        )


def masked(
    docs: DataFrame,
    owner: str = "source",
    repository: str = "doc_id",
    copied_owners: int = COPIED_OWNERS,
    copied_repositories: int = COPIED_REPOSITORIES,
) -> DataFrame:
    """All documents with their secrets masked, other columns as they were (``n_chars`` follows a changed text).

    Base spans are masked where they stand, without a join. Random tokens are masked where they are live;
    documents with such tokens, few, are known by a hash of id and text, so rows without an id are masked too.
    """
    holder = F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    narrow = docs.select(
        holder.alias("holder"),
        F.col("text").cast("string").alias("text"),
        F.col(owner).cast("string").alias("owner"),
        F.col(repository).cast("string").alias("repository"),
    )
    values = settle(
        narrow.mapInArrow(lean(_values), "holder long, value string, owner string, repository string, random boolean"),
        "secret-values",
    )
    live = ownership(values).filter(is_live(copied_owners, copied_repositories)).select("value")
    held = settle(
        values.filter("random").select("holder", "value").distinct().join(live, "value")
        .groupBy(F.col("holder").alias("__holder"))
        .agg(F.collect_set("value").alias("__live_values")),
        "secret-holders",
    )
    if held.isEmpty():
        joined = docs.withColumn("__live_values", F.lit(None).cast("array<string>"))
    else:
        joined = docs.join(held, holder == F.col("__holder"), "left").drop("__holder")
    length = "n_chars" if "n_chars" in docs.columns else None
    return joined.mapInArrow(lean(_masker(length)), docs.schema)
