"""Content-addressed store of token ids.

Each document's ids (its end id last) are cut into chunks where a rolling hash over the last ``reach`` ids has
its low bits zero, so equal passages give equal chunks wherever they stand. Chunks lie between ``least`` and
``most`` ids. A chunk's address is the 128-bit BLAKE2b of its bytes. On disk, below one folder:

* ``staged/kind=chunk``: digest, n, ids (little-endian, ``width`` bytes an id), each digest once;
* ``recipes``: doc_id, n_tokens, n_chunks, digests (16 bytes each, one after another), root, part, row; files in
  ascending doc_id order, ``part`` the number of the file's partition, ``row`` ascending over all recipes;
* ``manifest``: part, n_documents, n_tokens, root; a Merkle root over the part's document roots in order.

A document's root is the Merkle root over its chunk digests. Reading checks every chunk against its address,
every document against its root and length, and every part against the manifest; a difference is an error.

Only chunks are shuffled, once, dealt by digest: within a map task a digest is sent once, so a passage that
a third of all documents hold reaches its reducer once per map task. Recipes are sorted by range.

Defined cases: a null text is empty (one end id); a null doc_id sorts first; repeated rows get a recipe each; rows of one doc_id are
ordered by their roots, and equal ones are interchangeable; a very long text is many chunks and one recipe; other columns are ignored,
whatever their names; an empty table gives an empty store.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallywright.llm import textkernel as tk
from tallywright.llm.components import own_exchange
from tallywright.llm.scratch import fresh_path, small_batches
from tallywright.llm.token_ids import Encoder

DIGEST = 16
#: Distinct chunks that a map task remembers as already sent.
MOST_SENT = 1 << 20
STAGED = "kind string, deal long, digest binary, n int, ids binary, doc_id long, n_tokens long, digests binary, root binary"
STAGED_NAMES = [x.split()[0] for x in STAGED.split(", ")]


@dataclass(frozen=True)
class Cutting:
    """Chunk borders: about one in ``mean`` ids, between ``least`` and ``most`` ids apart."""

    mean: int = 256
    least: int = 32
    most: int = 1024
    reach: int = 16


def digest_of(raw: bytes) -> bytes:
    return hashlib.blake2b(raw, digest_size=DIGEST).digest()


def merkle_root(leaves: list[bytes]) -> bytes:
    """Binary tree; an odd last node moves up as it is; leaves and nodes are hashed apart."""
    level = [digest_of(b"\0" + x) for x in leaves] or [digest_of(b"")]
    while len(level) > 1:
        level = [digest_of(b"\1" + level[i] + level[i + 1]) if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]
    return level[0]


def borders(ids: np.ndarray, offsets: np.ndarray, cut: Cutting) -> list[list[int]]:
    """Chunk ends of each document, as indices into ``ids``."""
    up, down = tk.powers(len(ids) + 1)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(tk.mix(ids.astype(np.uint64) + np.uint64(1)) * up[: len(ids)], dtype=np.uint64)])
    back = np.maximum(np.arange(1, len(ids) + 1) - cut.reach, 0)
    rolled = tk.mix((total[1:] - total[back]) * down[back])
    hits = np.flatnonzero(rolled % np.uint64(cut.mean) == 0) + 1
    out, edges = [], np.searchsorted(hits, offsets)
    for s, e, lo, hi in zip(offsets[:-1].tolist(), offsets[1:].tolist(), edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        ends, at = [], s
        for h in [*hits[lo:hi].tolist(), e]:
            if h - at < cut.least and h < e:
                continue
            while h - at > cut.most:
                at += cut.most
                ends.append(at)
            if h > at:
                ends.append(h)
                at = h
        out.append(ends)
    return out


def _stage(tokenizer: str, end_id: int, width: int, cut: Cutting):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, sent = Encoder.at(tokenizer), set()
        for batch in batches:
            for lo, hi, ids, offsets in encoder.encode(batch.column(1), end_id):
                if len(ids) and int(ids.max()) >> 8 * width:
                    raise ValueError(f"id {int(ids.max())} doesn't fit in {width} bytes")
                raw = ids.astype(f"<u{width}").tobytes()
                chunks, recipes, at = [], [], 0
                for doc, ends in zip(batch.column(0).slice(lo, hi - lo).cast(pa.int64()).to_pylist(), borders(ids, offsets, cut), strict=True):
                    digests, first = [], at
                    for e in ends:
                        body = raw[at * width : e * width]
                        d = digest_of(body)
                        digests.append(d)
                        if d not in sent:
                            if len(sent) >= MOST_SENT:
                                sent.clear()
                            sent.add(d)
                            chunks.append((d, e - at, body))
                        at = e
                    recipes.append((doc, at - first, b"".join(digests), merkle_root(digests)))
                n, m = len(chunks), len(recipes)
                deal = [int.from_bytes(c[0][:8], "little", signed=True) for c in chunks] + [int.from_bytes(r[3][:8], "little", signed=True) for r in recipes]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(["chunk"] * n + ["recipe"] * m),
                        pa.array(deal, pa.int64()),
                        *(pa.array([c[i] for c in chunks] + [None] * m, kind) for i, kind in enumerate((pa.binary(), pa.int32(), pa.binary()))),
                        *(pa.array([None] * n + [r[i] for r in recipes], kind) for i, kind in enumerate((pa.int64(), pa.int64(), pa.binary(), pa.binary()))),
                    ],
                    STAGED_NAMES,
                )

    return run


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The partition's number and the row's place in the order of all recipes, behind every recipe."""
    context = TaskContext.get()
    part = context.partitionId() if context else 0
    at = part << 33
    for batch in batches:
        n = batch.num_rows
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(n, part, np.int64)), pa.array(np.arange(at, at + n))], [*batch.schema.names, "part", "row"])
        at += n


def _roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """part, n_documents, n_tokens, root of each part; its recipes come one after another, in order."""
    part, leaves, tokens, out = None, [], 0, []
    for batch in batches:
        for p, n, root in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
            if p != part:
                if leaves:
                    out.append((part, len(leaves), tokens, merkle_root(leaves)))
                part, leaves, tokens = p, [], 0
            leaves.append(root)
            tokens += n
    if leaves:
        out.append((part, len(leaves), tokens, merkle_root(leaves)))
    yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], k) for i, k in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.binary()))], ["part", "n_documents", "n_tokens", "root"])


def _manifest_of(recipes: DataFrame) -> DataFrame:
    ordered = recipes.select("part", "n_tokens", "root", "row").repartition("part").sortWithinPartitions("part", "row")
    return ordered.mapInArrow(_roots, "part long, n_documents long, n_tokens long, root binary")


def width_of(tokenizer: str, end_id: int) -> int:
    """Bytes an id that hold every id of the tokenizer, and ``end_id``."""
    most = max(end_id, *Encoder.at(tokenizer).tokenizer.get_vocab(with_added_tokens=True).values())
    return 2 if most < 1 << 16 else 4


def write_store(documents: DataFrame, path: str, tokenizer: str, end_id: int, width: int = 2, cut: Cutting = Cutting()) -> None:
    """``width``: 2 for ids below 65,536, else 4 (see ``width_of``); an id that doesn't fit is an error."""
    spark = documents.sparkSession
    small_batches(spark)
    staged = documents.select("doc_id", "text").mapInArrow(_stage(tokenizer, end_id, width, cut), STAGED)
    dealt = staged.repartition("deal").sortWithinPartitions("kind", "digest")

    def unique(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            keep = []
            for d in batch.column(2).to_pylist():
                keep.append(d is None or d != last)
                last = d
            yield batch.filter(pa.array(keep))

    once = dealt.mapInArrow(unique, STAGED).drop("deal")
    once.write.option("compression", "zstd").partitionBy("kind").parquet(f"{path}/staged")
    _staged(spark, path, "recipe").select("doc_id", "n_tokens", (F.length("digests") / DIGEST).cast("int").alias("n_chunks"), "digests", "root").repartitionByRange(F.asc_nulls_first("doc_id")).sortWithinPartitions(F.asc_nulls_first("doc_id"), "root").mapInArrow(_parts, "doc_id long, n_tokens long, n_chunks int, digests binary, root binary, part long, row long").write.parquet(f"{path}/recipes")
    _manifest_of(spark.read.parquet(f"{path}/recipes")).write.parquet(f"{path}/manifest")


def _staged(spark: SparkSession, path: str, kind: str) -> DataFrame:
    return spark.read.schema(STAGED.replace("deal long, ", "")).parquet(f"{path}/staged").where(F.col("kind") == kind)


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    return _staged(spark, path, "chunk").select("digest", "n", "ids")


class Crc32:
    """CRC-32 of joined texts from those of their parts: appending n bytes is a linear map on the 32 bits."""

    def __init__(self):
        one = [0xEDB88320, *(1 << i for i in range(31))]  # a zero bit appended
        self.steps = [one]
        self.maps: dict[int, list[list[int]]] = {}

    @staticmethod
    def _apply(columns: list[int], value: int) -> int:
        out = 0
        for c in columns:
            if value & 1:
                out ^= c
            value >>= 1
            if not value:
                break
        return out

    def _bytes(self, n: int) -> list[list[int]]:
        if n not in self.maps:
            columns, bits, k = [1 << i for i in range(32)], 8 * n, 0
            while bits >> k:
                while len(self.steps) <= k:
                    self.steps.append([self._apply(self.steps[-1], c) for c in self.steps[-1]])
                if bits >> k & 1:
                    columns = [self._apply(self.steps[k], c) for c in columns]
                k += 1
            self.maps[n] = [[self._apply(columns[8 * b : 8 * b + 8], v) for v in range(256)] for b in range(4)]
        return self.maps[n]

    def join(self, left: int, right: int, n: int) -> int:
        """Of texts with these CRCs, the right one n bytes long."""
        a, b, c, d = self._bytes(n)
        return a[left & 255] ^ b[left >> 8 & 255] ^ c[left >> 16 & 255] ^ d[left >> 24] ^ right


def _checked_chunks(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            crcs = []
            for d, n, body in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
                if digest_of(body) != d or len(body) != n * width:
                    raise ValueError(f"chunk {d.hex()} doesn't match its address")
                crcs.append(zlib.crc32(np.frombuffer(body, f"<u{width}").astype("<u4")))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(crcs, pa.int64())], ["digest", "n", "crc"])

    return run


def _rebuilt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    crc = Crc32()
    for batch in batches:
        out = []
        chunks = batch.column(6)
        at, n, crcs = (f.to_numpy(zero_copy_only=False) for f in chunks.flatten().flatten())
        edges = np.concatenate([[0], np.cumsum(np.diff(chunks.offsets.to_numpy()))])
        order = np.lexsort((at, np.repeat(np.arange(len(chunks)), np.diff(edges))))
        at, sizes, crcs = at[order], n[order].tolist(), crcs[order].tolist()
        total = np.concatenate([[0], np.cumsum(n[order])])
        rows = zip(*(batch.column(c).to_pylist() for c in range(2, 6)), edges[:-1].tolist(), edges[1:].tolist(), strict=True)
        for doc, n_tokens, digests, root, lo, hi in rows:
            value = 0
            for k in range(lo, hi):
                value = crc.join(value, crcs[k], 4 * sizes[k])
            whole = [digests[i : i + DIGEST] for i in range(0, len(digests), DIGEST)]
            if hi - lo != len(whole) or (at[lo:hi] != np.arange(len(whole))).any() or total[hi] - total[lo] != n_tokens or merkle_root(whole) != root:
                raise ValueError(f"document {doc} can't be rebuilt from the store")
            out.append(value)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), batch.column(3), pa.array(out, pa.int64())], ["part", "row", "doc_id", "n_tokens", "ids_crc32"])


def _verified_recipes(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Recipes and manifest, held against each other."""
    recipes = spark.read.parquet(f"{path}/recipes")
    kept = spark.read.parquet(f"{path}/manifest")
    found = _manifest_of(recipes)
    wrong = kept.exceptAll(found).unionAll(found.exceptAll(kept)).limit(1).count()
    if wrong:
        raise ValueError("the recipes don't match the manifest")
    return recipes, kept


def _places(recipes: DataFrame) -> DataFrame:
    each = recipes.select("row", F.explode(F.sequence(F.lit(0), F.col("n_chunks") - 1)).alias("at"), "digests")
    return each.select("row", "at", F.substring("digests", F.col("at") * DIGEST + 1, F.lit(DIGEST)).alias("address"))


def _with_chunks(recipes: DataFrame, got: DataFrame) -> DataFrame:
    got = got.select(own_exchange(F.col("row")).alias("of"), "chunks")
    return recipes.join(got, F.col("row") == F.col("of")).select("part", "row", "doc_id", "n_tokens", "digests", "root", "chunks")


def _with_start(rebuilt: DataFrame, kept: DataFrame) -> DataFrame:
    before = kept.select(F.col("part").alias("own"), (F.sum("n_tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))).alias("base"))
    inside = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("row").rowsBetween(Window.unboundedPreceding, -1))
    return rebuilt.withColumn("inside", inside).join(before, F.col("part") == F.col("own")).withColumn("start", F.coalesce("base", F.lit(0)) + F.coalesce("inside", F.lit(0)))


def read_digests(spark: SparkSession, path: str, width: int = 2) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files; all of the store is verified."""
    recipes, kept = _verified_recipes(spark, path)
    chunks = read_chunks(spark, path).mapInArrow(_checked_chunks(width), "digest binary, n int, crc long")
    got = _places(recipes).join(chunks, F.col("address") == F.col("digest")).groupBy("row").agg(F.collect_list(F.struct("at", "n", "crc")).alias("chunks"))
    rebuilt = _with_chunks(recipes, got).mapInArrow(_rebuilt, "part long, row long, doc_id long, n_tokens long, ids_crc32 long")
    return _with_start(rebuilt, kept).select("doc_id", "start", "n_tokens", "ids_crc32")


def _joined(width: int):
    """Recipes with the bytes of their chunks, to ids; every chunk is checked against its address."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, n_tokens, digests, root, chunks in zip(*(batch.column(c).to_pylist() for c in range(2, 7)), strict=True):
                bodies = [x["ids"] for x in sorted(chunks, key=lambda x: x["at"])]
                whole = [digests[i : i + DIGEST] for i in range(0, len(digests), DIGEST)]
                raw = b"".join(bodies)
                if [digest_of(x) for x in bodies] != whole or len(raw) != n_tokens * width or merkle_root(whole) != root:
                    raise ValueError(f"document {doc} can't be rebuilt from the store")
                out.append(np.frombuffer(raw, f"<u{width}").astype(np.int64))
            ids = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum([len(x) for x in out])]), pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int64), *out])))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), batch.column(3), ids], ["part", "row", "doc_id", "n_tokens", "ids"])

    return run


def read_ids(spark: SparkSession, path: str, width: int = 2) -> DataFrame:
    """doc_id, start, ids (end id last) of every document, rebuilt from its chunks; all of the store is verified."""
    small_batches(spark)
    recipes, kept = _verified_recipes(spark, path)
    chunks = read_chunks(spark, path).select("digest", "ids")
    got = _places(recipes).join(chunks, F.col("address") == F.col("digest")).groupBy("row").agg(F.collect_list(F.struct("at", "ids")).alias("chunks"))
    rebuilt = _with_chunks(recipes, got).mapInArrow(_joined(width), "part long, row long, doc_id long, n_tokens long, ids array<long>")
    return _with_start(rebuilt, kept).select("doc_id", "start", "ids")


def store_and_read(documents: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    """Write a store in the shared folder and read it back."""
    spark = documents.sparkSession
    path, width = fresh_path(spark, "tokens"), width_of(tokenizer, end_id)
    write_store(documents, path, tokenizer, end_id, width)
    return read_digests(spark, path, width)
