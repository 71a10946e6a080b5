"""MinHash near-dedup with sequential Bayesian verification.

1. One narrow Arrow pass gives each document its shingle count, a digest of its shingle set and a signature of
   128 minima. Documents with equal sets form a class, represented by its smallest identifier.
2. Signatures are cut into 32 bands of 4 rows. In every band bucket each member is paired with the smallest
   member, never with all others.
3. Pairs are verified in sequence: signatures are compared 16 minima at a time, and a pair goes as soon as
   P(similarity >= threshold | matches so far) under a uniform prior falls below `miss`. Survivors are verified
   exactly on their whole shingle sets, and components of the links are formed.
4. Buckets of three or more whose members still lie in several components are compared again, all members of
   different components against each other, block by block in numpy. The largest component of a bucket is cut
   into blocks that meet only the other members, so a big group costs its size times the few that stay apart.
   A pair is compared in the first band it shares, by signatures alone at first. Only members with a surviving pair
   come back with their shingle sets, survivors are verified exactly on the spot, and a block gives only the links
   that join components, fewer than it has rows. Then the components are formed anew.

Hot sets, buckets and centres are salted by their counted rows.

A pair at the threshold shares no band with probability (1 - 0.75**4)**32 = 5e-6.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicloom.llm.components import components
from topicloom.llm.shared import intermediate, key_filter, key_hash, lean, lookup, materialize, maybe_in, prepare, salted_join, scratch_path, without_keys
from topicloom.llm.shingles import U64, mix, shingle_sets

SHINGLE_WORDS = 5
HASHES, BANDS, ROWS = 128, 32, 4
BATCH = 16
THRESHOLD = (75, 100)
MISS = 1e-6
BLOCK = 1024

_RNG = np.random.Generator(np.random.PCG64(77))
_A = _RNG.integers(0, 2**64, HASHES, dtype=U64) | U64(1)
_B = _RNG.integers(0, 2**64, HASHES, dtype=U64)
_BAND_MIX = _RNG.integers(0, 2**64, ROWS, dtype=U64) | U64(1)


def signature(shingles: np.ndarray) -> np.ndarray:
    """HASHES minima, their upper 32 bits."""
    low = np.full(HASHES, 2**64 - 1, dtype=U64)
    for i in range(0, len(shingles), 2048):
        part = shingles[i : i + 2048]
        np.minimum(low, (_A[:, None] * part[None, :] + _B[:, None]).min(axis=1), out=low)
    return (low >> U64(32)).astype(np.uint32)


@cache
def least_matches(compared: int, miss: float = MISS, top: int = THRESHOLD[0], of: int = THRESHOLD[1]) -> int:
    """The fewest matches of `compared` with which P(similarity >= top / of) is at least `miss`.

    With a uniform prior that probability is P(Binomial(compared + 1, top / of) <= matches).
    """
    p, total = top / of, 0.0
    for m in range(compared + 1):
        total += comb(compared + 1, m) * p**m * (1 - p) ** (compared + 1 - m)
        if total >= miss:
            return m
    return compared


def _profiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        counts, digests, sigs = [], [], []
        for s in shingle_sets(b.column(1), SHINGLE_WORDS):
            counts.append(len(s))
            digests.append(xxhash.xxh3_128_digest(s.tobytes()))
            sigs.append(signature(s).tobytes())
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array(counts, pa.int64()), pa.array(digests, pa.binary()), pa.array(sigs, pa.binary())],
            ["id", "n_shingles", "set_digest", "sig"],
        )


def _matrix(column: pa.Array, dtype, width: int) -> np.ndarray:
    """Equal binaries of `width` items each as rows."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype=dtype).reshape(len(column), width)


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seeds = mix(np.arange(1, BANDS + 1, dtype=U64))
    for b in batches:
        if not b.num_rows:
            continue
        sig = _matrix(b.column(1), np.uint32, HASHES).astype(U64).reshape(-1, BANDS, ROWS)
        bucket = mix((mix(sig + U64(1)) * _BAND_MIX).sum(axis=2, dtype=U64) + seeds[None, :])
        bucket = bucket & ~U64(BANDS - 1) | np.arange(BANDS, dtype=U64)[None, :]  # the band can be read off
        yield pa.RecordBatch.from_arrays(
            [pa.array(bucket.reshape(-1).view(np.int64)), pa.array(np.repeat(b.column(0).to_numpy(), BANDS))], ["bucket", "rep"]
        )


def _bayes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (x, y, sx, sy): batch by batch of the signatures, those that may reach the threshold stay."""
    for b in batches:
        if not b.num_rows:
            continue
        x, y = _matrix(b.column(2), np.uint32, HASHES), _matrix(b.column(3), np.uint32, HASHES)
        alive, matches = np.arange(b.num_rows), np.zeros(b.num_rows, dtype=np.int64)
        for c in range(0, HASHES, BATCH):
            matches = matches + (x[alive, c : c + BATCH] == y[alive, c : c + BATCH]).sum(axis=1)
            ok = matches >= least_matches(c + BATCH)
            alive, matches = alive[ok], matches[ok]
        take = pa.array(alive)
        yield pa.RecordBatch.from_arrays([b.column(0).take(take), b.column(1).take(take)], ["x", "y"])


def _full(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        sets = list(shingle_sets(b.column(1), SHINGLE_WORDS))
        sizes, sigs, raw = [len(s) for s in sets], [signature(s).tobytes() for s in sets], [s.tobytes() for s in sets]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes, pa.int64()), pa.array(sigs, pa.binary()), pa.array(raw, pa.binary())], ["rep", "size", "sig", "set"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        sets = [s.tobytes() for s in shingle_sets(b.column(1), SHINGLE_WORDS)]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sets, pa.large_binary()).cast(pa.binary())], ["id", "set"])


def _linked(p: np.ndarray, q: np.ndarray) -> bool:
    """Whether two sets, as sorted arrays, share enough of their union."""
    small, large = (p, q) if len(p) < len(q) else (q, p)
    if not len(small) or len(small) * THRESHOLD[1] < len(large) * THRESHOLD[0]:
        return False
    at = np.minimum(np.searchsorted(large, small), len(large) - 1)
    common = int((large[at] == small).sum())
    return common * THRESHOLD[1] >= (len(p) + len(q) - common) * THRESHOLD[0]


def _exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (x, y, set of x, set of y) that share enough of their union."""
    for b in batches:
        keep = []
        for i in range(b.num_rows):
            p = np.frombuffer(b.column(2)[i].as_buffer(), dtype=U64)
            q = np.frombuffer(b.column(3)[i].as_buffer(), dtype=U64)
            if _linked(p, q):
                keep.append(i)
        take = pa.array(keep, pa.int64())
        yield pa.RecordBatch.from_arrays([b.column(0).take(take), b.column(1).take(take)], ["x", "y"])


def _survivors(band: int, rows: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows (cell, bucket, side, rep, comp, size, sig, ...) of one cell: pairs of places whose signatures pass, and how
    many minima they share."""
    side = np.array([r[2] for r in rows])
    rep, comp, size = (np.array([r[k] for r in rows], dtype=np.int64) for k in (3, 4, 5))
    sig = np.frombuffer(b"".join(r[6] for r in rows), dtype=np.uint32).reshape(-1, HASHES)
    left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = [(np.zeros(0, dtype=np.int64),) * 3]
    for at in range(0, len(left), 64):
        own = left[at : at + 64]
        apart = comp[own][:, None] != comp[right][None, :]
        if side.max() > 1:  # one block with itself: each pair once
            apart &= rep[own][:, None] < rep[right][None, :]
        i, j = np.nonzero(apart)
        i, j = own[i], right[j]
        close = np.minimum(size[i], size[j]) * THRESHOLD[1] >= np.maximum(size[i], size[j]) * THRESHOLD[0]
        i, j = i[close], j[close]
        matches = np.zeros(len(i), dtype=np.int64)
        for c in range(0, HASHES, BATCH):
            matches = matches + (sig[i, c : c + BATCH] == sig[j, c : c + BATCH]).sum(axis=1)
            ok = matches >= least_matches(c + BATCH)
            i, j, matches = i[ok], j[ok], matches[ok]
        same = (sig[i] == sig[j]).reshape(-1, BANDS, ROWS).all(axis=2)
        first = same.argmax(axis=1) == band
        found.append((i[first], j[first], matches[first]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _with_survivors(band: int, rows: list[tuple]) -> tuple[list[str], list[int]]:
    """The cell and the members that have a surviving pair in it."""
    i, j, _ = _survivors(band, rows)
    reps = [rows[k][3] for k in np.union1d(i, j).tolist()]
    return [rows[0][0]] * len(reps), reps


def _joining_links(band: int, rows: list[tuple]) -> tuple[list[int], list[int]]:
    """Rows that end with the shingle set: verified links that join the cell's components."""
    i, j, matches = _survivors(band, rows)
    root = {r[4]: r[4] for r in rows}

    def find(c: int) -> int:
        while root[c] != c:
            root[c] = root[root[c]]
            c = root[c]
        return c

    x, y = [], []
    for k in np.argsort(-matches, kind="stable").tolist():
        p, q = rows[int(i[k])], rows[int(j[k])]
        a, b = find(p[4]), find(q[4])
        if a != b and _linked(np.frombuffer(p[7], dtype=U64), np.frombuffer(q[7], dtype=U64)):
            root[max(a, b)] = min(a, b)
            x.append(p[3])
            y.append(q[3])
    return x, y


def _cells(work, names: tuple[str, str], first_type: pa.DataType):
    """Rows sorted by cell go to `work`, a cell at a time; a cell has at most two blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_cell, rows = None, []

        def close() -> pa.RecordBatch:
            a, b = work(rows[0][1] & (BANDS - 1), rows) if len(rows) > 1 else ([], [])
            return pa.RecordBatch.from_arrays([pa.array(a, first_type), pa.array(b, pa.int64())], list(names))

        for b in batches:
            for r in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if r[0] != open_cell:
                    if rows:
                        yield close()
                    open_cell, rows = r[0], []
                rows.append(r)
        if rows:
            yield close()

    return run


def _verified(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (x, y) whose whole shingle sets reach the threshold; `pairs` is a table, and many may share an x."""
    ids = pairs.select(F.col("x").alias("id")).unionByName(pairs.select(F.col("y").alias("id")))
    sets = materialize(maybe_in(docs, key_hash("id"), key_filter(ids, key_hash("id"))).mapInArrow(lean(_sets), "id long, set binary"), "shingle-sets")
    centres = pairs.groupBy("x").agg(F.count(F.lit(1)).alias("n")).join(sets.select(F.col("id").alias("x"), F.col("set").alias("p")), "x")
    spokes = pairs.join(sets.select(F.col("id").alias("y"), F.col("set").alias("q")), "y")
    joined = salted_join(spokes, materialize(centres, "centres"), ["x"], "n", pairs.count(), "y")
    return joined.select("x", "y", "p", "q").mapInArrow(lean(_exact), "x long, y long").select(F.col("x").alias("u"), F.col("y").alias("v"))


def _apart(bands: DataFrame, buckets: DataFrame, labels: DataFrame) -> DataFrame | None:
    """Members of buckets with several components: (bucket, rep, comp, major, n_major, n_minor); None if there are none."""
    members = (
        lookup(bands, buckets.where("n > 2").select("bucket", "n"), ["bucket"], "n", bands.count(), "rep")
        .join(labels.withColumnRenamed("node", "rep"), "rep", "left")
        .select("bucket", "rep", F.coalesce("component", "rep").alias("comp"))
    )
    members = materialize(members, "bucket-members")
    sizes = materialize(members.groupBy("bucket", "comp").agg(F.count(F.lit(1)).alias("n")), "bucket-components")
    stats = materialize(
        sizes.groupBy("bucket")
        .agg(F.max(F.struct("n", "comp")).alias("top"), F.sum("n").alias("total"), F.count(F.lit(1)).alias("components"))
        .where("components > 1")
        .select("bucket", F.col("top.comp").alias("major"), F.col("top.n").alias("n_major"), (F.col("total") - F.col("top.n")).alias("n_minor"), "total"),
        "mixed-buckets",
    )
    if stats.isEmpty():
        return None
    return lookup(members, stats, ["bucket"], "total", members.count(), "rep").drop("total")


def _cell_links(docs: DataFrame, sigs: DataFrame, apart: DataFrame) -> DataFrame:
    """Verified links (u, v) between the components of mixed buckets."""
    apart = materialize(apart, "apart")
    big, small = f"cast(ceil(n_major / {BLOCK}) as int)", f"cast(ceil(n_minor / {BLOCK}) as int)"
    own = f"cast(pmod(xxhash64(rep, bucket), if(comp = major, {big}, {small})) as int)"
    placed = apart.withColumn("block", F.expr(own)).withColumn("big", F.expr(big)).withColumn("small", F.expr(small))
    # A cell is (kind, i, j): kind 0 is a major block against a minor one, kind 1 two minor blocks, 2 one with itself.
    cells = F.expr(
        """if(comp = major,
              transform(sequence(0, small - 1), j -> struct(0 as kind, block as i, j as j, 0 as side)),
              concat(transform(sequence(0, big - 1), i -> struct(0 as kind, i as i, block as j, 1 as side)),
                     transform(sequence(0, small - 1), k -> struct(if(k = block, 2, 1) as kind, least(k, block) as i,
                       greatest(k, block) as j, if(k = block, 2, if(k < block, 1, 0)) as side))))"""
    )
    dealt = placed.select("bucket", "rep", "comp", F.explode(cells).alias("c"))
    name = F.concat_ws(":", "bucket", "c.kind", "c.i", "c.j")
    dealt = dealt.select(name.alias("cell"), "bucket", F.col("c.side").alias("side"), "rep", "comp")
    columns = ["cell", "bucket", "side", "rep", "comp", "size", "sig"]
    near = materialize(maybe_in(sigs.select("rep", "size", "sig"), key_hash("rep"), key_filter(apart, key_hash("rep"))), "apart-signatures")
    signed = dealt.join(near, "rep").select(*columns).repartition("cell").sortWithinPartitions("cell")
    marked = materialize(signed.mapInArrow(lean(_cells(_with_survivors, ("cell", "rep"), pa.string())), "cell string, rep long"), "cell-survivors")
    found = maybe_in(docs, key_hash("id"), key_filter(marked, key_hash("rep")))
    known = materialize(found.mapInArrow(lean(_full), "rep long, size long, sig binary, set binary"), "apart-sets")
    back = dealt.join(marked, ["cell", "rep"]).join(known, "rep").select(*columns, "set")
    links = back.repartition("cell").sortWithinPartitions("cell").mapInArrow(lean(_cells(_joining_links, ("u", "v"), pa.int64())), "u long, v long")
    return links


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id_col, n_shingles, component_id, kept.

    Documents are linked when 100 * |A and B| >= 75 * |A or B| over their sets of 5-word shingles; component_id is
    the smallest identifier reachable. Null, empty and blank texts have no shingles and stay alone. Rows with the
    same identifier count as one node; a row without identifier stays alone, is kept and has no component.
    An empty table gives an empty result.
    """
    prepare(docs.sparkSession)
    base = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    profile = materialize(base.mapInArrow(lean(_profiles), "id long, n_shingles long, set_digest binary, sig binary"), "profiles")
    some = profile.where("n_shingles > 0 and id is not null")
    sigs = materialize(
        some.groupBy("set_digest").agg(F.min("id").alias("rep"), F.first("sig").alias("sig"), F.first("n_shingles").alias("size"), F.count(F.lit(1)).alias("n")),
        "signatures",
    )
    # An identifier whose rows stand in several classes ties them: each class by a link to the identifier's first one.
    several = some.groupBy("id").agg(F.min("set_digest").alias("a"), F.max("set_digest").alias("b")).where("a <> b").select("id")
    tied = some.select("id", "set_digest").join(materialize(several, "several"), "id", "left_semi").join(sigs.select("set_digest", "rep"), "set_digest")
    ties = tied.where("id <> rep").select(F.col("rep").alias("u"), F.col("id").alias("v")).distinct()
    bands = materialize(sigs.select("rep", "sig").mapInArrow(lean(_bands), "bucket long, rep long"), "bands")
    buckets = materialize(
        bands.groupBy("bucket").agg(F.min("rep").alias("center"), F.count(F.lit(1)).alias("n")).where("n > 1"), "buckets"
    )
    shared = materialize(maybe_in(bands, key_hash("bucket"), key_filter(buckets, key_hash("bucket"))), "shared-bands")
    met = lookup(shared, buckets, ["bucket"], "n", shared.count(), "rep").where("rep <> center")
    stars = materialize(met.select(F.col("center").alias("x"), F.col("rep").alias("y")).distinct(), "stars")
    # Most documents are in no pair: their signatures stay where they are.
    ends = stars.select(F.col("x").alias("id")).unionByName(stars.select(F.col("y").alias("id")))
    near = materialize(maybe_in(sigs.select("rep", "sig"), key_hash("rep"), key_filter(ends, key_hash("id"))), "near-signatures")
    centres = stars.groupBy("x").agg(F.count(F.lit(1)).alias("n")).join(near.select(F.col("rep").alias("x"), F.col("sig").alias("sx")), "x")
    signed = stars.join(near.select(F.col("rep").alias("y"), F.col("sig").alias("sy")), "y")
    signed = salted_join(signed, materialize(centres, "star-centres"), ["x"], "n", stars.count(), "y")
    likely = materialize(signed.select("x", "y", "sx", "sy").mapInArrow(lean(_bayes), "x long, y long").distinct(), "star-survivors")
    links = materialize(_verified(base, likely).unionByName(ties), "links")
    labels = materialize(components(links), "labels")

    apart = _apart(shared, buckets, labels)
    if apart is not None:
        more = materialize(_cell_links(base, sigs, apart), "cell-links")
        labels = materialize(components(links.unionByName(more)), "labels")

    classes = sigs.select("set_digest", "rep", "n").join(labels, F.col("rep") == F.col("node"), "left")
    classes = materialize(classes.select("set_digest", F.coalesce("component", "rep").alias("component_id"), "n"), "classes")
    settled_rows = lookup(some.select("id", "n_shingles", "set_digest"), classes, ["set_digest"], "n", some.count(), "id").select("id", "n_shingles", "component_id")
    alone = profile.where("not (n_shingles > 0 and id is not null)").select("id", "n_shingles", F.col("id").alias("component_id"))
    out = settled_rows.unionByName(alone)
    return out.select(F.col("id").alias(id_col), "n_shingles", "component_id").withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` that stay: one document of each component, the one with the smallest identifier."""
    spark, path = docs.sparkSession, scratch_path(docs.sparkSession, "near-marks")
    with intermediate(spark):
        near_duplicates(docs, id_col, text_col).write.parquet(path)
    marked = spark.read.parquet(path)
    gone = marked.where(~F.col("kept")).select(F.col(id_col).cast("long").alias("id")).distinct()
    return without_keys(docs, gone, {"id": F.col(f"`{id_col}`").cast("long")})


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return near_duplicates(docs)
