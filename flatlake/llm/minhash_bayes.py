"""Near-duplicate documents: MinHash bands, sequential Bayesian pruning, exact verification, components."""

from __future__ import annotations

from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .linking import components, joined, only, pair_of, written
from .textkit import LOWER, Prefix, U, buffer_of, mix, pieces, word_hashes, words

LAST_ID = (1 << 63) - 1
#: Hash functions, rows of a band, hashes compared at a time, and the chance of missing a true link at each look.
HASHES, ROWS, BATCH, MISS = 120, 5, 20, 1e-7
STEP = 1 << 20
#: Families up to FEW members compare their open pairs directly; larger ones take a centre from CENTRE_SAMPLE members.
FEW, CENTRE_SAMPLE = 16, 64

_RNG = np.random.RandomState(77)
_XOR = _RNG.randint(0, 1 << 32, HASHES, dtype=np.uint64).astype(np.uint32)
_MUL = (_RNG.randint(0, 1 << 31, HASHES, dtype=np.uint64) * 2 + 1).astype(np.uint32)

SIGNED = "id bigint, n bigint, set_a bigint, set_b bigint, bands array<bigint>, signature binary"
SIGNED_ARROW = pa.schema([("id", pa.int64()), ("n", pa.int64()), ("set_a", pa.int64()), ("set_b", pa.int64()), ("bands", pa.list_(pa.int64())), ("signature", pa.binary())])


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each row's k-word shingles (A-Z lowered; fewer words: one shingle)."""
    data = LOWER[data]
    starts, ends, first = words(data, offsets)
    values = Prefix(mix(word_hashes(data, starts, ends) ^ U(0x1234567887654321)))
    grams = values.grams(k)
    out = []
    for lo, hi in zip(first[:-1].tolist(), first[1:].tolist()):
        if hi - lo >= k:
            out.append(np.unique(grams[lo : hi - k + 1]))
        elif hi > lo:
            out.append(mix(values.ranges(np.array([lo]), np.array([hi])) + U(hi - lo)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _signed(k: int):
    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            data, offsets = buffer_of(batch.column(1))
            for lo, hi in pieces(offsets, STEP):
                sets = shingle_sets(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], k)
                n = np.array([len(s) for s in sets], np.int64)
                full = n > 0
                a, b = np.zeros((2, hi - lo), np.int64)
                signature = np.zeros((int(full.sum()), HASHES), np.uint32)
                bands = np.zeros((len(signature), HASHES // ROWS), np.int64)
                if len(signature):
                    flat = np.concatenate(sets)
                    at = (np.cumsum(n) - n)[full]
                    a[full] = np.add.reduceat(mix(flat ^ U(0x9E3779B97F4A7C15)), at).view(np.int64)
                    b[full] = np.add.reduceat(mix(flat + U(0x632BE59BD9B4E019)), at).view(np.int64)
                    x = (flat >> U(32)).astype(np.uint32)
                    for i in range(HASHES):
                        signature[:, i] = np.minimum.reduceat((x ^ _XOR[i]) * _MUL[i], at)
                    wide = signature.reshape(len(signature), -1, ROWS).astype(np.uint64)
                    h = np.zeros(wide.shape[:2], U) + np.arange(wide.shape[1], dtype=U)
                    for r in range(ROWS):
                        h = mix(h * U(0xD6E8FEB86659FD93) + wide[:, :, r])
                    bands = h.view(np.int64)
                row = np.cumsum(full) - 1
                lengths = np.where(full, bands.shape[1], 0)
                band_at = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
                sign_at = np.concatenate([[0], np.cumsum(np.where(full, 4 * HASHES, 0))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids[lo:hi]), pa.array(n), pa.array(a), pa.array(b),
                    pa.ListArray.from_arrays(pa.array(band_at), pa.array(bands.reshape(-1))),
                    pa.Array.from_buffers(pa.binary(), hi - lo, [None, pa.py_buffer(sign_at.tobytes()), pa.py_buffer(signature.tobytes())]),
                ], schema=SIGNED_ARROW)

    return run


def least_matches(similarity: float, miss: float = MISS, hashes: int = HASHES, batch: int = BATCH) -> list[int]:
    """Per look (after each batch of hashes), the fewest matches that keep a pair.

    With a uniform prior the similarity given m matches of n is
    Beta(m + 1, n - m + 1), whose chance of reaching the threshold t is the
    binomial tail P(Bin(n + 1, t) <= m).  Below *miss* the pair is pruned.
    """
    out = []
    for n in range(batch, hashes + 1, batch):
        total, m = 0.0, -1
        while total < miss:
            m += 1
            total += comb(n + 1, m) * similarity**m * (1 - similarity) ** (n + 1 - m)
        out.append(m)
    return out


def _plausible(similarity: float):
    """Pairs that survive the posterior bound at every look at their signatures."""
    bounds = least_matches(similarity)

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            left, _ = buffer_of(batch.column(2))
            right, _ = buffer_of(batch.column(3))
            x = left.tobytes(), right.tobytes()
            x, y = (np.frombuffer(v, np.uint32).reshape(-1, HASHES) for v in x)
            alive, matches = np.arange(len(x)), np.zeros(len(x), np.int64)
            for look, least in enumerate(bounds):
                part = slice(look * BATCH, (look + 1) * BATCH)
                matches = matches + (x[alive, part] == y[alive, part]).sum(axis=1)
                ok = matches >= least
                alive, matches = alive[ok], matches[ok]
            yield batch.select([0, 1]).take(pa.array(alive))

    return run


def _exact(k: int, percent: int):
    """Pairs with 100 * intersection >= percent * union on the full shingle sets of their texts."""

    def run(batches):
        for batch in batches:
            keep = []
            seen: dict = {}
            for i in range(batch.num_rows):
                sets = []
                for ids, texts in ((0, 2), (1, 3)):
                    key = (ids, batch.column(ids)[i].as_py())
                    text = batch.column(texts)[i].as_buffer()
                    key = (*key, hash(text.to_pybytes()) if text is not None else 0)
                    if key not in seen:
                        if len(seen) > 64:
                            seen.clear()
                        data = np.frombuffer(text, np.uint8) if text is not None else np.zeros(0, np.uint8)
                        seen[key] = shingle_sets(data, np.array([0, len(data)]), k)[0]
                    sets.append(seen[key])
                x, y = sets
                common = len(np.intersect1d(x, y, assume_unique=True))
                if common and 100 * common >= percent * (len(x) + len(y) - common):
                    keep.append(i)
            yield batch.select([0, 1]).take(pa.array(keep, pa.int64()))

    return run


def _differences(k: int, percent: int):
    """(fam, id, text, centre) -> what a document's set and its family's centre do not share, and its weight.

    For sets x, y and any centre M let D = x xor M.  Then x and y are linked
    exactly if 2 (100 + percent) |Dx & Dy| >= Qx + Qy with
    Q = 200 |M - x| + 2 percent |x - M| - (100 - percent) |M|.
    """

    def run(batches):
        for batch in batches:
            keep, weights, parts = [], [], []
            for i in range(batch.num_rows):
                text = batch.column(2)[i].as_buffer()
                data = np.frombuffer(text, np.uint8)
                own = shingle_sets(data, np.array([0, len(data)]), k)[0]
                centre = np.sort(batch.column(3)[i].values.to_numpy(zero_copy_only=False).view(U))
                missing = np.setdiff1d(centre, own, assume_unique=True)
                added = np.setdiff1d(own, centre, assume_unique=True)
                weights.append(200 * len(missing) + 2 * percent * len(added) - (100 - percent) * len(centre))
                parts.append(np.concatenate([missing, added]))
                keep.append(i)
            at = np.concatenate([[0], np.cumsum([len(x) for x in parts])]).astype(np.int32)
            flat = np.concatenate(parts).view(np.int64) if parts else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.array(weights, np.int64)), pa.ListArray.from_arrays(pa.array(at), pa.array(flat))], names=["fam", "id", "q", "differs"])

    return run


def _elements(k: int):
    def run(batches):
        for batch in batches:
            data, offsets = buffer_of(batch.column(1))
            fams = batch.column(0).to_numpy(zero_copy_only=False)
            sets = shingle_sets(data, offsets, k)
            yield pa.RecordBatch.from_pydict({"fam": np.repeat(fams, [len(x) for x in sets]), "e": (np.concatenate(sets) if sets else np.zeros(0, U)).view(np.int64)})

    return run


class Linker:
    """Links and components of representatives that share a band, without comparing all pairs of a bucket.

    1. Every member of a bucket meets the bucket's smallest id.  What is in one
       component then is settled.
    2. A family is what met the same smallest id, linked with it or not (so any
       two members of a bucket are in one).  A family of at most FEW members
       that is not settled compares its pairs across components.
    3. A larger one gets a centre: the shingles that most of a bounded sample
       of its members hold (any set would do, a near one is fast).  Two members
       whose weights add up to no more than zero are linked and so is each of
       them with the member of least weight; any other link needs shingles in
       common among the differences from the centre, at least as many as the
       weights say.  So all members meet the one of least weight, and an index
       on differences (held by two or more, rarest first, only as many as the
       bound needs) brings the others together: first with the least of each
       index entry, then, across components, with each other.

    Every pair goes through the posterior bound on signatures and then the
    exact comparison.  No bucket, family or entry is cut.
    """

    def __init__(self, narrow: DataFrame, signed: DataFrame, k: int, percent: int):
        self.narrow, self.signed, self.k, self.percent = narrow, signed, k, percent

    def verified(self, pairs: DataFrame) -> DataFrame:
        """Links among ``pairs(a, b)``."""
        both = pairs.join(self.signatures.withColumnRenamed("id", "b"), "b").withColumnRenamed("signature", "y").join(self.signatures.withColumnRenamed("id", "a"), "a")
        likely = written(both.select("a", "b", F.col("signature").alias("x"), "y").mapInArrow(_plausible(self.percent / 100), "a bigint, b bigint"), "likely")
        sides = likely.join(self.texts.withColumnRenamed("id", "b"), "b").withColumnRenamed("text", "y").join(self.texts.withColumnRenamed("id", "a"), "a")
        return written(sides.select("a", "b", F.col("text").alias("x"), "y").mapInArrow(_exact(self.k, self.percent), "a bigint, b bigint"), "links")

    def linked(self, members: DataFrame) -> DataFrame:
        """``(id, component)`` of every id with a link, from buckets ``members(key, id)``."""
        least = members.groupBy("key").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).filter("lo < hi").drop("hi")
        met = written(members.join(least, "key").filter("id != lo").select(F.col("lo").alias("a"), F.col("id").alias("b")).distinct(), "met")
        involved = written(met.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "involved")
        self.signatures = written(only(self.signed.filter("n > 0").select("id", "signature"), involved, "id"), "signatures")
        self.texts = written(only(self.narrow.filter(F.octet_length("text") > 0), involved, "id"), "texts")
        known = written(components(self.verified(met)), "components")
        families = met.select(F.col("a").alias("fam"), F.col("b").alias("id"))
        labelled = self._labelled(families, known)
        mixed = labelled.groupBy("fam").agg(F.count(F.lit(1)).alias("size"), F.min("label").alias("x"), F.max("label").alias("y")).filter("x < y").select("fam", "size")
        open_members = written(labelled.join(mixed, "fam"), "open")
        few = open_members.filter(F.col("size") <= FEW)
        other = few.select("fam", F.col("id").alias("p"), F.col("label").alias("other"))
        pairs = few.join(other, "fam").filter("id < p and label != other").select(F.col("id").alias("a"), F.col("p").alias("b"))
        large = open_members.filter(F.col("size") > FEW).select("fam", "id")
        if large.isEmpty():
            return joined(known, self.verified(pairs.distinct().join(met, ["a", "b"], "left_anti")))
        entries = self._index(large)
        hubs = self._hubs(entries)
        known = joined(known, self.verified(pairs.unionByName(hubs).distinct().join(met, ["a", "b"], "left_anti")))
        labelled = self._labelled(entries, known)
        mixed = labelled.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y")).filter("x < y").select("key")
        rest = written(labelled.join(mixed, "key").select("key", "fam", "id", "q", "need", "common", "label"), "entries")
        right = rest.select("key", F.col("id").alias("p"), F.col("q").alias("pq"), F.col("need").alias("pneed"), F.col("common").alias("pcommon"), F.col("label").alias("other"))
        # two members cannot share more differences than either has in common with anyone
        able = f"id < p and label != other and {2 * (100 + self.percent)} * least(common, pcommon) >= q + pq"
        shared = rest.join(right, "key").filter(able).groupBy("fam", "id", "p", "q", "pq", "need", "pneed").agg(F.count(F.lit(1)).alias("n"))
        # a shared difference is not counted if one of the two did not keep it, which left out need - 1 of its own
        enough = shared.filter(f"{2 * (100 + self.percent)} * (n + need + pneed - 2) >= q + pq")
        last = enough.select(F.col("id").alias("a"), F.col("p").alias("b")).distinct()
        return joined(known, self.verified(last.join(met, ["a", "b"], "left_anti")))

    @staticmethod
    def _labelled(rows: DataFrame, known: DataFrame) -> DataFrame:
        return rows.join(known, "id", "left").withColumn("label", F.coalesce("component", "id")).drop("component")

    def _index(self, large: DataFrame) -> DataFrame:
        """``(key, fam, id, q, need, common)``: members of large families under the differences they must share to be linked."""
        turn = Window.partitionBy("fam").orderBy(F.xxhash64("id"), "id")
        sample = large.withColumn("turn", F.row_number().over(turn)).filter(F.col("turn") <= CENTRE_SAMPLE).select("fam", "id")
        sample = written(sample, "centre-sample")
        sizes = sample.groupBy("fam").agg(F.count(F.lit(1)).alias("m"))
        held = sample.join(self.texts, "id").select("fam", "text").mapInArrow(_elements(self.k), "fam bigint, e bigint").groupBy("fam", "e").agg(F.count(F.lit(1)).alias("c"))
        centre = held.join(sizes, "fam").filter("2 * c > m").groupBy("fam").agg(F.collect_list("e").alias("centre"))
        centre = written(sizes.select("fam").join(centre, "fam", "left").select("fam", F.coalesce("centre", F.array().cast("array<bigint>")).alias("centre")), "centres")
        placed = large.join(self.texts, "id").join(centre, "fam").select("fam", "id", "text", "centre")
        self.apart = written(placed.mapInArrow(_differences(self.k, self.percent), "fam bigint, id bigint, q bigint, differs array<bigint>"), "apart")
        least = self.apart.groupBy("fam").agg(F.min("q").alias("least"))
        need = F.greatest(F.lit(1), F.ceil((F.col("q") + F.col("least")) / F.lit(2.0 * (100 + self.percent))))
        each = self.apart.join(least, "fam").select("fam", "id", "q", need.alias("need"), F.explode("differs").alias("e"))
        held = self.apart.select("fam", F.explode("differs").alias("e")).groupBy("fam", "e").agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
        own = Window.partitionBy("fam", "id")
        kept = each.join(held, ["fam", "e"]).withColumn("n", F.count(F.lit(1)).over(own)).filter("n >= need").withColumn("turn", F.row_number().over(own.orderBy("c", "e"))).filter("turn <= n - need + 1")
        return written(kept.select(F.xxhash64("fam", "e").alias("key"), "fam", "id", "q", "need", F.col("n").alias("common")), "index")

    def _hubs(self, entries: DataFrame) -> DataFrame:
        hub = self.apart.groupBy("fam").agg(F.min(F.struct("q", "id")).alias("hub")).select("fam", F.col("hub.id").alias("p"))
        whole = self.apart.join(hub, "fam").select("id", "p")
        of_entry = entries.groupBy("key").agg(F.min(F.struct("q", "id")).alias("hub"), F.count(F.lit(1)).alias("m")).filter("m > 1").select("key", F.col("hub.id").alias("p"))
        return pair_of(whole.unionByName(entries.join(of_entry, "key").select("id", "p")).filter("id != p"), "id", "p")


def near_duplicates(docs: DataFrame, k: int = 3, percent: int = 85, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, n_shingles, component_id, kept)`` for every row of *docs*.

    Documents are linked when the Jaccard similarity of their sets of k-word
    shingles (A-Z lowered) is at least *percent* / 100; ``component_id`` is the
    smallest id reachable over links and ``kept`` marks that document.

    Equal sets are folded to their smallest id first (128-bit set digests), so
    copies cost one aggregate.  Representatives share a candidate bucket when a
    band of ROWS MinHashes agrees (a pair at 0.85 is missed by all 24 bands
    with probability 8e-7; at 0.8 with 8e-5); pairs are pruned by the posterior
    bound on their signatures and every survivor is verified on full sets.
    ``Linker`` says which pairs are compared.

    Defined cases: a null or empty text has an empty set and is linked with
    nothing; fewer than k words are one shingle; a null id counts as the
    largest and comes back as null with itself as component; rows that share an
    id are one node and stand or fall together; an empty table gives an empty
    result; other columns are ignored.
    """
    narrow = docs.select(F.coalesce(F.col(id_col).cast("bigint"), F.lit(LAST_ID)).alias("id"), F.col(text_col).cast("string").alias("text"))
    signed = written(narrow.mapInArrow(_signed(k), SIGNED), "signatures")
    # equal sets have equal bands, so any copy's will do for the smallest id
    folded = written(signed.filter("n > 0").groupBy("set_a", "set_b", "n").agg(F.min("id").alias("rep"), F.any_value("bands").alias("bands")), "folded")
    members = folded.select(F.explode("bands").alias("key"), F.col("rep").alias("id"))
    linked = Linker(narrow, signed, k, percent).linked(members)
    grouped = folded.join(linked, F.col("rep") == F.col("id"), "left").select("set_a", "set_b", "n", F.coalesce("component", "rep").alias("component"))
    placed = signed.select("id", "n", "set_a", "set_b").join(grouped, ["set_a", "set_b", "n"], "left")
    placed = placed.select("id", "n", F.coalesce("component", "id").alias("component"))
    null_id = F.col("id") == LAST_ID
    return placed.select(
        F.when(~null_id, F.col("id")).alias(id_col),
        F.col("n").alias("n_shingles"),
        F.when(F.col("component") != LAST_ID, F.col("component")).alias("component_id"),
        (F.col("id") == F.col("component")).alias("kept"),
    )


def op8_minhash_bayes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
