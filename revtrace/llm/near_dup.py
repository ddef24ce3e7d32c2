"""MinHash near-deduplication: one-permutation hashing, banded buckets, star-shaped edges.

1. *Signature.* A document's set of five-word shingles (64-bit hashes, sorted) is
   split by range into ``BANDS * ROWS`` bins; each bin keeps its minimum, empty bins
   are filled by optimal densification (each empty bin tries bins in its own
   random order until one is filled). Equal sets are one *class*: copies never
   multiply edges.
2. *Buckets.* ``BANDS`` bands of ``ROWS`` minima. Sets with a similarity of 0.75
   share a bucket with probability 1 - (1 - 0.75**5)**40 = 0.99998. Minima of small sets depend on each
   other, so sets of up to ``SMALL`` shingles also have an exact path: similar sets share one
   of their n - ceil(0.75 n) + 1 smallest hashes, and each of these is a bucket.
3. *Star edges.* In every bucket one class is the centre, the one whose
   buckets are fullest, and each other member is compared with it only. Links are
   confirmed on full sets: 100 * intersection >= 75 * union.
4. *No link is lost.* Buckets whose members still lie in different components are open. In open buckets of
   up to ``CROWD`` members those leave whose signature fits no member of another component. For the rest the
   full sets say exactly who can still link. Of members u and v, with centre h, the common
   shingles lie in h, less what u or v lacks of it (counted by a bit set, never too many), or outside,
   at most the smaller number of those that some other partner of h has outside h too. A member that no set
   of the bucket's sizes could reach leaves; in a group of near copies with edits of their own that is
   every one that its centre does not reach. The rest gets further rounds: members of different
   components are compared where this bound allows a link. One round compares
   at most ``PAIRS_PER_DOCUMENT`` pairs per document of the input; if more are left, a random share of each
   bucket's members (at least one) are the centres of the round, meet all
   others, and leave. A bucket is done when its members are one component or all pairs across
   components were compared, so the components are those of all candidate pairs.

   Pairs are first compared by their signatures, four bits of each of the 200 minima:
   fewer than six standard deviations below what a similarity of 0.75 gives are not compared in full.
   The deviation grows as sets get smaller (fewer bins are their own); sets of a dozen shingles are always compared.
5. *Components.* Rounds of large-star and small-star on the confirmed edges, as
   joins and grouped minima, each written to the shared checkpoint folder.

Nothing is collected but counters. Hot buckets and hot components are joined
with one row per key, so adaptive execution can split them.

Defined results: null or blank texts have an empty set: linked with nothing, each
its own component. Rows repeating id and text are one document and get equal rows.
``component_id`` is the smallest non-null id reachable (the row's own id for
an empty set). An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revtrace.llm.common import BLOOM, arrow_rows, bloom_filters, carried, keyed, materialize, text_of
from revtrace.llm.words import mix, pieces, shingle_sets
from revtrace.operators import graph
from revtrace.session import discard

WIDTH = 5
PERCENT = 75
BANDS, ROWS = 40, 5
BINS = BANDS * ROWS
#: So many signatures per document of the input are compared in one round.
PAIRS_PER_DOCUMENT = 16
#: In open buckets of up to so many members, signatures say first whose full sets are needed.
CROWD = 16
#: Pairs whose smaller set has up to three quarters of this are found by the exact path too.
SMALL = 32
#: Standard deviations below the expected number of equal minima.
SURE = 6
_LONGS = 13
_WORDS = 16

_EDGES = np.array([(k << 64) // BINS for k in range(BINS)], np.uint64)
_TRIES = 4096


def _attempt(t: int, bins: np.ndarray) -> np.ndarray:
    """The bin that each of ``bins`` looks into at its t-th attempt."""
    x = mix(bins.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(t * 0x632BE59B + 1))
    return (x % np.uint64(BINS)).astype(np.int64)


_ORDER = [_attempt(t, np.arange(BINS)) for t in range(64)]


def signature(shingles: np.ndarray) -> np.ndarray:
    """BINS minima of a non-empty sorted set."""
    at = np.searchsorted(shingles, _EDGES)
    ends = np.append(at[1:], len(shingles))
    filled = ends > at
    out = shingles[np.minimum(at, len(shingles) - 1)]
    left = np.flatnonzero(~filled)
    t = 0
    while len(left) and t < _TRIES:
        look = _ORDER[t][left] if t < len(_ORDER) else _attempt(t, left)
        hit = filled[look]
        out[left[hit]] = out[look[hit]]
        left = left[~hit]
        t += 1
    if len(left):  # hardly ever: the next filled bin
        full = np.flatnonzero(filled)
        out[left] = out[full[np.searchsorted(full, left) % len(full)]]
    return out


def bands(minima: np.ndarray) -> np.ndarray:
    """One 64-bit bucket key per band."""
    rows = minima.reshape(BANDS, ROWS)
    key = mix(np.arange(1, BANDS + 1, dtype=np.uint64))
    for k in range(ROWS):
        key = mix(key * np.uint64(0xD1342543DE82EF95) + rows[:, k])
    return key.astype(np.int64)


def smallest(shingles: np.ndarray) -> np.ndarray:
    """The hashes of a small sorted set of which a similar set must share one; none for larger sets."""
    n = len(shingles)
    return shingles[: n - -(-n * PERCENT // 100) + 1 if n <= SMALL else 0].view(np.int64)


def packed(minima: np.ndarray) -> np.ndarray:
    """Four bits of each minimum, sixteen to a long."""
    bits = np.zeros(16 * _LONGS, np.uint64)
    bits[:BINS] = mix(minima) & np.uint64(15)
    return (bits.reshape(_LONGS, 16) << np.arange(0, 64, 4, dtype=np.uint64)).sum(1, dtype=np.uint64).view(np.int64)


def _agree(a: str, b: str):
    """How many minima of two packed signatures are equal."""
    total = F.lit(0)
    for k in range(_LONGS):
        x = F.col(a)[k].bitwiseXOR(F.col(b)[k])
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 2)).bitwiseAND(F.lit(0x1111111111111111))
        total = total + F.bit_count(x)
    return F.lit(BINS) - total


def _may_link(a: str, b: str, na: str, nb: str):
    """Whether two signatures leave room for a link, for sets of these sizes."""
    own = F.lit(float(BINS)) * (F.lit(1.0) - F.exp(-F.least(na, nb) / F.lit(float(BINS))))  # bins filled
    share = PERCENT / 100
    expected = BINS * (share + (1 - share) / 16)
    return _agree(a, b) >= F.lit(expected) - F.lit(SURE * BINS * (share * (1 - share)) ** 0.5) / F.sqrt(own)


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces(batch.column(2)):
            n, digest, keys, short = [], [], [], []
            for s in shingle_sets(piece, WIDTH):
                n.append(len(s))
                digest.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                minima = signature(s) if len(s) else None
                keys.append(np.concatenate((bands(minima), smallest(s))) if len(s) else None)
                short.append(packed(minima) if len(s) else None)
            ids = [c.slice(piece.first, piece.last - piece.first) for c in batch.columns[:2]]
            yield pa.RecordBatch.from_arrays(
                [*ids, pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.array(keys, pa.list_(pa.int64())), pa.array(short, pa.list_(pa.int64()))],
                ["_id", "_h", "_n", "_set", "_bands", "_sig"],
            )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(_set, _shingles) from (_set, _text)."""
    for batch in batches:
        for piece in pieces(batch.column(1)):
            found = [s.view(np.int64) for s in shingle_sets(piece, WIDTH)]
            name = batch.column(0).slice(piece.first, piece.last - piece.first)
            yield pa.RecordBatch.from_arrays([name, pa.array(found, pa.list_(pa.int64()))], ["_set", "_shingles"])


def describe(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """_id, _h, _n (set size), _set (digest of the set, null if empty), _bands, _sig (packed minima): written once."""
    arrow_rows(df.sparkSession)
    schema = T.StructType(
        [
            T.StructField("_id", df.schema[id_col].dataType),
            T.StructField("_h", T.LongType()),
            T.StructField("_n", T.LongType()),
            T.StructField("_set", T.BinaryType()),
            T.StructField("_bands", T.ArrayType(T.LongType())),
            T.StructField("_sig", T.ArrayType(T.LongType())),
        ]
    )
    return materialize(keyed(df, id_col, text_col).mapInArrow(_describe, schema), "near-dup-bands")


def bucket_members(docs: DataFrame) -> DataFrame:
    """(_band, _bucket, _set, _n, _score) for classes that share a bucket with another class.

    ``_score`` is how many members the buckets of a class have in all: a text
    from which many copies were made stands out in its neighbourhood.
    """
    classes = docs.where("_set IS NOT NULL").groupBy("_set").agg(F.min(F.struct("_n", "_bands")).alias("_c"))
    rows = classes.select("_set", F.col("_c._n").alias("_n"), F.posexplode("_c._bands").alias("_band", "_bucket"))
    rows = rows.withColumn("_band", F.least("_band", F.lit(BANDS)))  # hashes of small sets are one band
    counts = rows.groupBy("_band", "_bucket").agg(F.count(F.lit(1)).alias("_size")).where("_size > 1")
    shared = materialize(rows.join(counts, ["_band", "_bucket"]), "near-dup-buckets")
    score = shared.groupBy("_set").agg(F.sum("_size").alias("_score"))
    members = materialize(shared.drop("_size").join(score, "_set"), "near-dup-members")
    discard(shared)
    return members


def signatures(docs: DataFrame, members: DataFrame) -> DataFrame:
    """(_set, _sig, _n) of every class that shares a bucket."""
    one = docs.where("_set IS NOT NULL").groupBy("_set").agg(F.min(F.struct("_sig", "_n")).alias("_s"))
    one = one.join(members.select("_set").distinct(), "_set", "left_semi")
    return materialize(one.select("_set", F.col("_s._sig").alias("_sig"), F.col("_s._n").alias("_n")), "near-dup-signatures")


def member_sets(df: DataFrame, docs: DataFrame, members: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(_set, _shingles) of every class that shares a bucket, from the whole text of one of its documents: written once.

    The documents asked for are a table of keys: broadcast where it is below the session's
    threshold, else joined by a shuffle of the texts that pass a Bloom filter of the keys.
    """
    one = docs.where("_set IS NOT NULL").groupBy("_set").agg(F.min(F.struct("_id", "_h")).alias("_d"), F.min("_n").alias("_dn"))
    one = one.join(members.select("_set").distinct(), "_set", "left_semi")
    # One key for id and hash: structs are equal where both hold null.
    key = F.struct(F.col("_d._id").alias("i"), F.col("_d._h").alias("h"))
    one = materialize(one.select("_set", key.alias("_key"), "_dn"), "near-dup-asked")
    schema = T.StructType([T.StructField("_set", T.BinaryType()), T.StructField("_shingles", T.ArrayType(T.LongType()))])
    texts = keyed(df, id_col, text_col).select(F.struct(F.col("_id").alias("i"), F.col("_h").alias("h")).alias("_key"), "_text")
    with bloom_filters(df.sparkSession):
        # Spark builds the filter from a side that is itself filtered.
        rows = texts.join(one.where("_dn > 0"), "_key").dropDuplicates(["_key"])
        sets = materialize(rows.select("_set", "_text").mapInArrow(_sets, schema), "near-dup-sets")
    discard(one)
    return sets


def alike(pairs: DataFrame, sigs: DataFrame) -> DataFrame:
    """The distinct pairs (_a, _b) whose signatures leave room for a link: written once."""
    left = sigs.select(F.col("_set").alias("_a"), F.col("_sig").alias("_ga"), F.col("_n").alias("_na"))
    right = sigs.select(F.col("_set").alias("_b"), F.col("_sig").alias("_gb"), F.col("_n").alias("_nb"))
    both = pairs.select("_a", "_b").distinct().join(left, "_a").join(right, "_b")
    return materialize(both.where(_may_link("_ga", "_gb", "_na", "_nb")).select("_a", "_b"), "near-dup-alike")


def _joined(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    left = sets.select(F.col("_set").alias("_a"), F.col("_shingles").alias("_sa"))
    right = sets.select(F.col("_set").alias("_b"), F.col("_shingles").alias("_sb"))
    return pairs.where("_a <> _b").join(left, "_a").join(right, "_b")


def confirm(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (_a, _b) whose full sets are similar enough."""
    common = F.size(F.array_intersect("_sa", "_sb"))
    union = F.size("_sa") + F.size("_sb") - common
    with bloom_filters(pairs.sparkSession):
        return materialize(_joined(pairs, sets).where(common * 100 >= union * PERCENT).select("_a", "_b"), "near-dup-links")


def _bits(shingles):
    """A bit set of 64 * ``_WORDS`` bits of some hashes."""
    word = lambda k: F.aggregate(
        F.filter(shingles, lambda x: F.pmod(x, F.lit(_WORDS)) == k),
        F.lit(0).cast("long"),
        lambda bits, x: bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), (F.shiftright(x, 4).bitwiseAND(F.lit(63))).cast("int"))),
    )
    return F.transform(F.array(*[F.lit(k) for k in range(_WORDS)]), word)


def _common():
    """The most shingles that a member and one of the same centre (columns ending in _c) can share.

    At least as many of the centre's shingles are missing in one of them as bits are set in either.
    """
    lost = F.lit(0)
    for k in range(_WORDS):
        lost = lost + F.bit_count(F.col("_gone")[k].bitwiseOR(F.col("_gone_c")[k]))
    return F.least(F.col("_hub") - lost, "_in", "_in_c") + F.least("_out", "_out_c")


def reach(rest: DataFrame, sets: DataFrame) -> DataFrame:
    """``rest`` with what ties each member to its centre: ``_hub`` and ``_in``, the centre's shingles and those it shares;
    ``_gone``, bits that stand for the others; ``_out``, shingles outside the centre that another partner has outside too.
    """
    pairs = materialize(rest.select(F.col("_set").alias("_a"), F.col("_centre").alias("_b")).distinct(), "near-dup-open-pairs")
    parts = _joined(pairs, sets).select("_a", "_b", F.size("_sa").alias("_na"), F.array_except("_sa", "_sb").alias("_own"), F.size("_sb").alias("_hub"), _bits(F.array_except("_sb", "_sa")).alias("_gone"))
    with bloom_filters(rest.sparkSession):
        parts = materialize(parts, "near-dup-parts")
    own = parts.select("_a", "_b", F.explode("_own").alias("_s"))
    again = own.groupBy("_b", "_s").agg(F.count(F.lit(1)).alias("_k")).where("_k > 1").drop("_k")
    outside = own.join(again, ["_b", "_s"], "left_semi").groupBy("_a", "_b").agg(F.count(F.lit(1)).alias("_out"))
    facts = parts.select("_a", "_b", (F.col("_na") - F.size("_own")).alias("_in"), "_hub", "_gone").join(outside, ["_a", "_b"], "left")
    facts = facts.select(F.col("_a").alias("_set"), F.col("_b").alias("_centre"), "_in", "_hub", "_gone", F.coalesce("_out", F.lit(0)).cast("long").alias("_out"))
    out = materialize(rest.join(facts, ["_set", "_centre"]), "near-dup-reach")
    discard(pairs, parts)
    return out


def tangled(rest: DataFrame, sigs: DataFrame, key: list[str]) -> DataFrame:
    """The members that some member of another component in their bucket may link with, by sizes and signatures.

    For buckets of bounded size; the others have nothing left to be compared with.
    """
    member = rest.join(sigs.drop("_n"), "_set")
    partner = member.select(*[F.col(c).alias(f"{c}_c") for c in (*key, "_set", "_n", "_sig", "_label")])
    met = [F.col(k) == F.col(f"{k}_c") for k in key] + [(F.col("_label") != F.col("_label_c")) & _fits("_n", "_n_c")]
    met += [_may_link("_sig", "_sig_c", "_n", "_n_c")]
    return member.join(partner, met, "left_semi").drop("_sig")


def components(edges: DataFrame) -> DataFrame:
    """(_set, _label): the smallest digest of each node's component, for nodes with an edge."""
    return graph.components(edges, "near-dup-star").withColumnRenamed("_node", "_set")


def _fits(a: str, b: str):
    """Sets of so different sizes cannot be similar enough."""
    return F.least(a, b) * 100 >= F.greatest(a, b) * PERCENT


def _open(rest: DataFrame, key: list[str]) -> DataFrame:
    """The buckets whose members lie in several components: members, pairs within components, smallest set."""
    groups = rest.groupBy(*key, "_label").agg(F.count(F.lit(1)).alias("_k"), F.min("_n").alias("_n")).groupBy(*key)
    groups = groups.agg(F.sum("_k").alias("_size"), F.sum(F.col("_k") * F.col("_k")).alias("_same"), F.min("_n").alias("_least"))
    return materialize(groups.where("_size * _size > _same"), "near-dup-open")


def _enough(common, n, other):
    """Whether ``common`` shared shingles would make sets of n and ``other`` shingles similar enough."""
    return common * 100 >= (n + other - common) * PERCENT


def linked(docs: DataFrame, members: DataFrame, sets: DataFrame) -> DataFrame:
    """(_set, _label): components of the confirmed links, which are those of all candidate pairs.

    ``sets`` holds the full sets of the classes in ``members``.
    """
    key = ["_band", "_bucket"]
    sigs, documents = signatures(docs, members), docs.count()
    centres = members.groupBy(*key).agg(F.max(F.struct("_score", "_set", "_n")).alias("_c"))
    stars = members.join(centres, key).where((F.col("_set") != F.col("_c._set")) & _fits("_n", "_c._n"))
    pairs = alike(stars.select(F.col("_set").alias("_a"), F.col("_c._set").alias("_b")), sigs)
    found = confirm(pairs, sets)
    discard(pairs)
    # A round's centres have met every member; they leave.
    rest = members.join(centres.select(*key, F.col("_c._set").alias("_centre")), key).where("_set <> _centre").drop("_score")
    turn, labels = 0, components(found)
    while True:
        rest = rest.join(labels, "_set", "left").withColumn("_label", F.coalesce("_label", "_set"))
        rest = materialize(rest, "near-dup-rest")
        groups = _open(rest, key)
        if turn == 0:
            crowds = materialize(rest.join(groups.select(*key, "_least", "_size"), key), "near-dup-crowds")
            few = tangled(crowds.where(F.col("_size") <= CROWD), sigs, key)
            rest = materialize(crowds.where(F.col("_size") > CROWD).unionByName(few).drop("_size"), "near-dup-rest")
            discard(groups, crowds)
            if not rest.isEmpty():
                # No set of the bucket is smaller than its smallest, and none holds more common shingles than it has.
                common = F.col("_in") + F.col("_out")
                rest = reach(rest, sets).where(_enough(common, F.col("_n"), F.greatest("_least", common)))
                rest = materialize(rest.drop("_least").join(sigs.drop("_n"), "_set"), "near-dup-rest")
            groups = _open(rest, key)
        untested = groups.agg(F.sum((F.col("_size") * F.col("_size") - F.col("_same")) / 2)).first()[0]
        if not untested:
            return labels
        rest = rest.join(groups.select(*key), key, "left_semi")
        share, turn = PAIRS_PER_DOCUMENT * documents / untested, turn + 1
        drawn = F.pmod(F.xxhash64("_set", F.lit(turn)), F.lit(1 << 20)) < int(share * (1 << 20))
        first = rest.groupBy(*key).agg(F.max(F.struct("_label", "_set")).alias("_f")).select(*key, F.col("_f._set").alias("_first"))
        rest = rest.join(first, key).withColumn("_chosen", drawn | (F.col("_set") == F.col("_first")))
        rest = materialize(rest.drop("_first"), "near-dup-round")
        columns = ("_set", "_n", "_sig", "_label", "_in", "_out", "_gone")
        centre = rest.where("_chosen").select(*key, *[F.col(c).alias(f"{c}_c") for c in columns])
        met = (F.col("_label") != F.col("_label_c")) & _fits("_n", "_n_c")
        met &= _enough(_common(), F.col("_n"), F.col("_n_c"))
        met &= _may_link("_sig", "_sig_c", "_n", "_n_c")
        # Two centres meet once.
        met &= ~F.col("_chosen") | (F.col("_set") < F.col("_set_c"))
        pairs = rest.alias("m").join(centre.alias("c"), [F.col(f"m.{k}") == F.col(f"c.{k}") for k in key] + [met])
        pairs = materialize(pairs.select(F.col("_set").alias("_a"), F.col("_set_c").alias("_b")).distinct(), "near-dup-alike")
        new = confirm(pairs, sets)
        if not new.isEmpty():
            found = found.unionByName(new)
            labels = components(found)
        discard(groups, pairs)
        rest = rest.where("NOT _chosen").drop("_chosen", "_label")


def near_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_shingles, component_id, kept (the id is the component's), stays, _h.

    ``stays`` marks exactly one document per component, also where ids are null or
    stand for several texts; a document with an empty set always stays.
    """
    docs = describe(df, id_col, text_col)
    members = bucket_members(docs)
    sets = member_sets(df, docs, members, id_col, text_col)
    labels = linked(docs, members, sets)
    discard(members, sets)
    first = F.struct(F.col("_id").isNull().alias("none"), "_id", "_h")
    least = docs.where("_set IS NOT NULL").groupBy("_set").agg(F.min(first).alias("_first"))
    least = least.join(labels, "_set", "left").withColumn("_label", F.coalesce("_label", "_set"))
    least = materialize(least, "near-dup-classes")
    smallest = least.groupBy("_label").agg(F.min("_first").alias("_first"))
    classes = least.drop("_first").join(smallest, "_label").select("_set", "_first")
    out = docs.drop("_bands", "_sig").join(classes, "_set", "left")
    alone = F.col("_set").isNull()
    cid = F.when(alone, F.col("_id")).otherwise(F.col("_first._id"))
    return out.select(
        F.col("_id").alias(id_col),
        F.col("_n").alias("n_shingles"),
        cid.alias("component_id"),
        F.col("_id").eqNullSafe(cid).alias("kept"),
        (alone | (F.col("_id").eqNullSafe(cid) & (F.col("_h") == F.col("_first._h")))).alias("stays"),
        "_h",
    )


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The input rows, all columns, of the one document of each component that stays."""
    go = near_dedup(df, id_col, text_col).where("NOT stays").select(F.col(id_col).alias("_gid"), F.col("_h").alias("_gh"))
    go = materialize(go.distinct(), "near-dup-go")
    rows = carried(df, _id=F.col(f"`{id_col}`"), _th=F.xxhash64(text_of(text_col)))
    gone = F.col("_id").eqNullSafe(F.col("_gid")) & (F.col("_th") == F.col("_gh"))
    return rows.join(go, gone, "left_anti").select("_row.*")


ORACLE_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (SELECT DISTINCT doc_id, array_to_string(w[k:k+4], ' ') AS s
             FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS k FROM d WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingles a JOIN shingles b USING (s)
           WHERE a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b),
least AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept, doc_id = component_id AS stays
FROM d JOIN least USING (doc_id) LEFT JOIN sizes USING (doc_id)
"""
