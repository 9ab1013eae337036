"""MinHash near-duplicate groups (operator 6).

One-permutation hashing with optimal densification, banded buckets, and
candidate edges shaped as stars around hubs:

1. A pass over the texts gives each row its exact set size, a 128-bit key of
   its shingle set, band hashes and one byte per bin. Rows with one key are one
   vertex (its smallest id), so copies never meet in a bucket.
2. Every member of a bucket is paired with the bucket's hub only: at most
   ``bands`` pairs per vertex, whatever the bucket's size. Each pair is
   confirmed on the full shingle sets of both texts. The members that the hub
   confirms are its star. Where more than ``block`` members of a bucket are in
   no star, the smallest of those is its next hub and meets all members, and so
   on for ``rounds`` rounds or until a round places less than an eighth.
3. Two members that are linked may lie in different stars. The distance 1 -
   Jaccard is a metric: if y is in the star of h and x links with y, then x is
   at most twice the threshold's distance from h. Only members in that ring
   around a hub, and of another component, are compared with the hub's star;
   members of no star are compared with each other. They are compared on their
   bins' bytes in blocks of bounded size and in the first band that a pair
   shares; pairs whose estimate is within five deviations of the threshold are
   confirmed too: first the two best of each member and block, then, for what
   is still apart, all others.
4. Components of the confirmed links give the groups.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.components import components
from tallyforge.llm.storage import bound_batches, lean, stored
from tallyforge.llm.texthash import distinct, mix, shared, shingles

EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
#: bins of a signature; the bands take the first ``rows * bands`` of them
BINS = 512
#: deviations below the threshold at which an estimate is still confirmed
DEVIATIONS = 5
ROWS = "doc_id long, n_shingles long, set_key binary, bands array<long>, bins binary"


@dataclass(frozen=True)
class Banding:
    rows: int
    bands: int


def banding(similarity: float, miss: float = 1e-7, most_bands: int = 32) -> Banding:
    """The most rows a band for which a pair at the threshold is missed at most with ``miss``."""
    for rows in range(12, 0, -1):
        bands = math.ceil(math.log(miss) / math.log1p(-(similarity**rows))) if similarity < 1 else 1
        if bands <= most_bands:
            return Banding(rows, bands)
    return Banding(1, math.ceil(math.log(miss) / math.log1p(-similarity)))


_targets: dict[tuple[int, int], np.ndarray] = {}


def _target(k: int, attempt: int) -> np.ndarray:
    """The bin that each empty bin tries at an attempt, the same for all documents."""
    if (k, attempt) not in _targets:
        made = (mix(np.arange(k, dtype=np.uint64) * np.uint64(0x100000001B3) + np.uint64(attempt)) % np.uint64(k)).astype(np.int64)
        if attempt > 4096:  # sets of very few shingles only
            return made
        _targets[k, attempt] = made
    return _targets[k, attempt]


def densify(values: np.ndarray, filled: np.ndarray) -> None:
    """Give each empty bin of each row the value of the filled bin that it tries first."""
    rows, bins = np.nonzero(~filled & filled.any(axis=1)[:, None])
    attempt = 0
    while len(rows):
        attempt += 1
        target = _target(values.shape[1], attempt)[bins]
        hit = filled[rows, target]
        values[rows[hit], bins[hit]] = values[rows[hit], target[hit]]
        rows, bins = rows[~hit], bins[~hit]


def signatures(sets: list[np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray]:
    """Per set one value per bin, the smallest hash that falls there: densified, and as a byte that is 0 for an empty bin."""
    h = np.concatenate([*sets, np.empty(0, np.uint64)])
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    y = mix(h ^ np.uint64(0xA5A5A5A5A5A5A5A5))
    at = owner * k + ((y >> np.uint64(32)) * np.uint64(k) >> np.uint64(32)).astype(np.int64)
    out = np.full(len(sets) * k, EMPTY)
    np.minimum.at(out, at, mix(y) | np.uint64(1))
    filled = np.zeros(len(sets) * k, bool)
    filled[at] = True
    byte = np.where(filled, 1 + (mix(out) >> np.uint64(32)) % np.uint64(255), 0).astype(np.uint8)
    out, filled = out.reshape(-1, k), filled.reshape(-1, k)
    densify(out, filled)
    return out, byte.reshape(-1, k)


def sliced(batches: Iterator[pa.RecordBatch], most: int = 1 << 19, rows: int = 256) -> Iterator[tuple[list, list[bytes]]]:
    """(ids, UTF-8 texts) in slices of about ``most`` bytes and ``rows`` texts at most; null is empty."""
    for batch in batches:
        ids, texts, size = [], [], 0
        for i, text in zip(batch[0], batch[1], strict=True):
            t = (text.as_py() or "").encode("utf-8", "surrogatepass")
            ids.append(i.as_py())
            texts.append(t)
            size += len(t)
            if size >= most or len(ids) >= rows:
                yield ids, texts
                ids, texts, size = [], [], 0
        if ids:
            yield ids, texts


def _sets(texts: list[bytes], words: int) -> list[np.ndarray]:
    h, counts = shingles(texts, words)
    ends = np.cumsum(counts)
    return [distinct(h[e - n : e]) for e, n in zip(ends, counts, strict=True)]


def _signatures(words: int, band: Banding):
    mult = mix(np.arange(1, band.rows + 1, dtype=np.uint64)) | np.uint64(1)
    salt = mix(np.arange(1000, 1000 + band.bands, dtype=np.uint64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in sliced(batches):
            sets = _sets(texts, words)
            sig, byte = signatures([x[:, 0] for x in sets], BINS)
            rows = sig[:, : band.bands * band.rows].reshape(len(sets), band.bands, band.rows)
            key = mix((rows * mult).sum(axis=2, dtype=np.uint64) + salt)
            short = (key >> np.uint64(32)).astype("<u4")
            some = [len(x) > 0 for x in sets]
            keys = [xxhash.xxh3_128_digest(x.tobytes()) if ok else None for x, ok in zip(sets, some, strict=True)]
            bands = [k.view(np.int64) if ok else None for k, ok in zip(key, some, strict=True)]
            bins = [b.tobytes() + k.tobytes() if ok else None for b, k, ok in zip(byte, short, some, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array([len(x) for x in sets], pa.int64()), pa.array(keys, pa.binary()), pa.array(bands, pa.list_(pa.int64())), pa.array(bins, pa.binary())],
                names=["doc_id", "n_shingles", "set_key", "bands", "bins"],
            )

    return run


def ring(percent: int) -> int:
    """The similarity in percent that a member linked with one of a hub's star has with the hub."""
    return 2 * percent - 100


def _confirm(words: int, percent: int):
    """On the full sets of both texts: 100 * intersection >= percent * union, and whether the pair is within the ring."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[str | None, np.ndarray | None] = (None, None)  # a hub's rows come together
        for batch in batches:
            for at in range(0, batch.num_rows, 32):
                part = batch.slice(at, 32)
                ta, tb = part[2].to_pylist(), part[3].to_pylist()
                new = [t for k, t in enumerate(ta) if t != (ta[k - 1] if k else last[0])]
                made = iter(_sets([t.encode("utf-8", "surrogatepass") for t in new + tb], words))
                fresh = iter([next(made) for _ in new])
                linked, near = [], []
                for text, b in zip(ta, made, strict=True):
                    if text != last[0]:
                        last = (text, next(fresh))
                    both = shared(last[1], b)
                    either = len(last[1]) + len(b) - both
                    linked.append(100 * both >= percent * either)
                    near.append(100 * both >= ring(percent) * either)
                yield pa.RecordBatch.from_arrays([part[0], part[1], pa.array(linked, pa.bool_()), pa.array(near, pa.bool_())], names=["a", "b", "linked", "near"])

    return run


def least_estimate(s: float, n: np.ndarray) -> np.ndarray:
    """The estimate that a pair of similarity ``s`` and smaller set ``n`` reaches but for DEVIATIONS.

    The bins that are not empty sample the union without replacement.
    """
    sampled = BINS * -np.expm1(-n / BINS)
    spread = s * (1 - s) / sampled * np.maximum(1 - sampled / (n / math.sqrt(s)), 0.1)
    return s - DEVIATIONS * np.sqrt(spread)


def _compare(percent: int, top: int | None):
    """Pairs worth confirming in each block of a bucket; rows come sorted by block.

    Columns: block, id, n, component, bins, asks, answers, number (the band's).
    A pair has one row that asks (a member its hub did not confirm) and one
    that answers. It is made in the first band only that both share: there too
    it has met its hub.
    """
    s = percent / 100

    def pairs(ids, n, comp, sig, asks, answers, number) -> tuple[np.ndarray, np.ndarray]:
        keys = np.ascontiguousarray(sig[:, BINS:]).view("<u4")[:, : number[0]]
        sig = sig[:, :BINS]
        outs_a, outs_b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        x = np.flatnonzero(answers)
        for r in np.flatnonzero(asks):
            ok = (comp[x] != comp[r]) & (np.minimum(n[x], n[r]) * 100 >= percent * np.maximum(n[x], n[r]))
            ok &= (ids[x] != ids[r]) & ~(asks[x] & answers[r] & (ids[x] < ids[r]))
            y = x[ok]
            y = y[~(keys[y] == keys[r]).any(axis=1)]
            if not len(y):
                continue
            like = ((sig[y] == sig[r]) & (sig[r] > 0)).sum(axis=1) / ((sig[y] | sig[r]) > 0).sum(axis=1)
            near = like >= least_estimate(s, np.minimum(n[y], n[r]))
            y, like = y[near], like[near]
            if top is not None and len(y) > top:
                y = y[np.argsort(-like, kind="stable")[:top]]
            outs_a.append(np.minimum(ids[y], ids[r]))
            outs_b.append(np.maximum(ids[y], ids[r]))
        return np.concatenate(outs_a), np.concatenate(outs_b)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def found(t: pa.Table) -> pa.RecordBatch:
            block = t["block"].to_numpy()
            ids, n, comp = (t[c].to_numpy() for c in ("id", "n", "component"))
            sig = np.frombuffer(b"".join(t["bins"].to_pylist()), np.uint8).reshape(len(ids), -1)
            asks, answers = (np.array(t[c].to_pylist(), bool) for c in ("asks", "answers"))
            number = t["number"].to_numpy()
            edges = [0, *(np.flatnonzero(block[1:] != block[:-1]) + 1), len(block)]
            made = [pairs(ids[i:j], n[i:j], comp[i:j], sig[i:j], asks[i:j], answers[i:j], number[i:j]) for i, j in zip(edges, edges[1:], strict=False)]
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate([m[k] for m in made]), pa.int64()) for k in (0, 1)], names=["a", "b"])

        for batch in batches:
            t = pa.Table.from_batches([batch])
            held = t if held is None else pa.concat_tables([held, t])
            block = held["block"].to_numpy()
            whole = int(np.searchsorted(block, block[-1]))
            if whole:
                yield found(held.slice(0, whole))
                held = held.slice(whole)
        if held is not None and len(held):
            yield found(held)

    return run


@dataclass(frozen=True)
class NearDuplicates:
    """words per shingle, similarity in percent; block: members compared at once; rounds: hubs of a large bucket."""

    words: int = 5
    percent: int = 80
    block: int = 256
    rounds: int = 8

    def __call__(self, docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """One row per input row: doc_id, n_shingles, component_id, kept.

        Words are runs of characters other than six blanks, with A-Z in lower
        case. A text of fewer words than a shingle is one shingle; one without
        words (or null) has the empty set and links with nothing, not even with
        another empty one. Equal sets are linked. Repeated rows give repeated
        result rows. A row without id joins the group of an equal set only.
        Other columns are not read. An empty table gives no rows.
        """
        bound_batches(docs.sparkSession)
        source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
        band = banding(self.percent / 100)
        rows = stored(source.mapInArrow(lean(_signatures(self.words, band)), ROWS), "minhash-rows")
        sets = stored(rows.where("set_key is not null").groupBy("set_key").agg(F.min("doc_id").alias("id")), "minhash-sets")
        first = rows.where("set_key is not null").join(sets.withColumnRenamed("id", "doc_id"), ["set_key", "doc_id"], "left_semi").dropDuplicates(["set_key"])
        reps = stored(first.select(F.col("doc_id").alias("id"), F.col("n_shingles").alias("n"), "bands", "bins"), "minhash-reps")

        members = reps.select("id", "n", F.posexplode("bands").alias("number", "band"))
        hubs = members.groupBy("band").agg(F.min(F.struct("id", "n")).alias("hub"), F.count("*").alias("size")).where("size > 1")
        hubs = stored(hubs.select("band", F.col("hub.id").alias("hub"), F.col("hub.n").alias("hub_n"), "size"), "minhash-hubs")
        inside = stored(members.join(hubs, "band"), "minhash-members")
        if inside.isEmpty():
            return self._result(rows, sets, None)

        texts = self._texts(source, inside)
        stars, rings, alone = self._stars(inside, texts)
        links = stars.select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct()
        for top in (2, None):
            labels = components(links) if not links.isEmpty() else None
            apart = self._apart(stars, rings, alone, reps, labels, top)
            if apart is None:
                break
            links = stored(links.unionByName(self._confirmed(apart, texts).where("linked").select("a", "b")).distinct(), "minhash-links")
        else:
            labels = components(links) if not links.isEmpty() else None
        return self._result(rows, sets, labels)

    def keep_one(self, docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """The rows, all columns, of the smallest id of each group."""
        found = self(docs, id_col=id_col, text_col=text_col)
        dropped = stored(found.groupBy(F.col("doc_id").alias("_dropped_id")).agg(F.max("kept").alias("kept")).where("not kept").select("_dropped_id"), "minhash-dropped")
        return docs.join(dropped, docs[id_col].cast("long").eqNullSafe(dropped["_dropped_id"]), "left_anti")

    @staticmethod
    def _texts(source: DataFrame, inside: DataFrame) -> DataFrame:
        ids = stored(inside.select(F.col("id").alias("doc_id")).distinct(), "minhash-ids")
        return stored(source.join(ids, "doc_id").where("text is not null"), "minhash-texts")

    def _confirmed(self, pairs: DataFrame, texts: DataFrame) -> DataFrame:
        """The pairs (a, b) with ``linked`` and ``near`` by the full sets; those that are neither are left out."""
        pairs = stored(pairs, "minhash-pairs")
        b = pairs.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
        a = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
        both = b.join(a, "a").select("a", "b", "text_a", "text_b")
        confirmed = both.mapInArrow(lean(_confirm(self.words, self.percent)), "a long, b long, linked boolean, near boolean")
        return stored(confirmed.where("near"), "minhash-confirmed")

    def _stars(self, inside: DataFrame, texts: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
        """Stars and rings (band, number, hub, id, n), and the members (band, number, id, n) of buckets of three and more that are in no star."""
        stars: DataFrame | None = None
        rings: DataFrame | None = None
        settled: DataFrame | None = None
        here, pending = inside.withColumn("before", F.col("size")), inside.where("size > 2").select("band", "number", "id", "n")
        for k in range(self.rounds):
            least = F.when(F.col("size") > 2, ring(self.percent)).otherwise(self.percent)  # a bucket of two has no ring
            met = here.where((F.col("id") != F.col("hub")) & (F.least("n", "hub_n") * 100 >= least * F.greatest("n", "hub_n")))
            found = self._confirmed(met.select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct(), texts)
            told = stored(met.select("band", "number", "hub", "id", "n", "size").join(found.select(F.col("a").alias("hub"), F.col("b").alias("id"), "linked"), ["hub", "id"]), "minhash-told")
            star = told.where("linked").drop("linked", "size")
            around = told.where("not linked and size > 2").drop("linked", "size")
            stars = star if stars is None else stars.unionByName(star)
            rings = around if rings is None else rings.unionByName(around)
            hubs = here.where("id = hub").select("band", "id", "before")
            placed = star.select("band", "id").union(hubs.select("band", "id"))
            alone = stored(pending.join(placed, ["band", "id"], "left_anti"), "minhash-alone")
            large = alone.groupBy("band").agg(F.min(F.struct("id", "n")).alias("hub"), F.count("*").alias("left")).where(F.col("left") > self.block)
            large = large.join(hubs.select("band", "before"), "band").where("8 * left <= 7 * before")  # where hubs place few, blocks are cheaper
            large = stored(large.select("band", F.col("hub.id").alias("hub"), F.col("hub.n").alias("hub_n"), F.col("left").alias("before")), "minhash-large")
            last = k == self.rounds - 1 or large.isEmpty()
            done = alone if last else alone.join(large, "band", "left_anti")  # buckets with few members left have no more rounds
            settled = done if settled is None else settled.unionByName(done)
            if last:
                break
            here = stored(inside.drop("hub", "hub_n").join(large, "band"), "minhash-round")
            pending = alone.join(large.select("band"), "band", "left_semi")
        return stored(stars, "minhash-stars"), stored(rings, "minhash-rings"), stored(settled, "minhash-settled")

    def _apart(self, stars: DataFrame, rings: DataFrame, alone: DataFrame, reps: DataFrame, labels: DataFrame | None, top: int | None) -> DataFrame | None:
        """Pairs of different components to confirm next; None if there are none."""

        def labelled(rows: DataFrame, of: str) -> DataFrame:
            if labels is None:
                return rows.withColumn(f"{of}_component", F.col(of))
            named = labels.select(F.col("vertex").alias(of), F.col("component").alias(f"{of}_component"))
            return rows.join(named, of, "left").withColumn(f"{of}_component", F.coalesce(f"{of}_component", of))

        asking = labelled(labelled(rings, "id"), "hub").where("id_component <> hub_component").withColumn("component", F.col("id_component"))
        group = F.xxhash64("band", "hub").alias("group")
        yes, no = F.lit(True), F.lit(False)
        columns = ["number", "id", "n"]
        asking = stored(asking.select(group, *columns, "component", yes.alias("asks"), no.alias("answers")), "minhash-asking")
        others = stored(labelled(alone, "id").select(F.xxhash64("band").alias("group"), *columns, F.col("id_component").alias("component"), yes.alias("asks"), yes.alias("answers")), "minhash-others")
        many = others.groupBy("group").agg(F.countDistinct("component").alias("parts")).where("parts > 1").select("group")
        here = others.join(stored(many, "minhash-open"), "group", "left_semi")
        if not asking.isEmpty():
            asked = stored(asking.select("group").distinct(), "minhash-asked")
            answering = stars.select(group, *columns).join(asked, "group", "left_semi")
            answering = labelled(answering, "id").select("group", *columns, F.col("id_component").alias("component"), no.alias("asks"), yes.alias("answers"))
            here = here.unionByName(asking).unionByName(answering)
        here = stored(here, "minhash-here")
        if here.isEmpty():
            return None
        sizes = stored(here.groupBy("group").agg(F.sum(F.col("asks").cast("int")).alias("n_asks"), F.sum(F.col("answers").cast("int")).alias("n_answers")), "minhash-sizes")
        here = here.join(sizes, "group").join(reps.select("id", "bins"), "id")
        # an asking member meets each block of answers, an answering one each block of those that ask:
        # where few ask, rows are few however large the bucket is
        asks = F.ceil(F.col("n_asks") / self.block).cast("int")
        answers = F.ceil(F.col("n_answers") / self.block).cast("int")
        columns += ["component", "bins"]

        def spread(rows: DataFrame, own: Column, facing: Column) -> DataFrame:
            return rows.select("group", *columns, F.pmod(F.xxhash64("id"), own).cast("int").alias("own"), F.explode(F.sequence(F.lit(0), facing - 1)).alias("other"))

        small = (asks <= 1) & (answers <= 1)
        one = here.where(small).select(F.col("group").alias("block"), *columns, "asks", "answers")
        large = here.where(~small & (asks > 0) & (answers > 0))
        ask = spread(large.where("asks"), asks, answers).select(F.xxhash64("group", "own", "other").alias("block"), *columns, yes.alias("asks"), no.alias("answers"))
        answer = spread(large.where("answers"), answers, asks).select(F.xxhash64("group", "other", "own").alias("block"), *columns, no.alias("asks"), yes.alias("answers"))
        dealt = one.unionByName(ask).unionByName(answer).repartition("block").sortWithinPartitions("block")
        pairs = stored(dealt.mapInArrow(lean(_compare(self.percent, top)), "a long, b long").distinct(), "minhash-apart")
        return None if pairs.isEmpty() else pairs

    @staticmethod
    def _result(rows: DataFrame, sets: DataFrame, labels: DataFrame | None) -> DataFrame:
        if labels is not None:
            found = sets.join(labels.withColumnRenamed("vertex", "id"), "id", "left").select("set_key", F.coalesce("component", "id").alias("component"))
            found = stored(found, "minhash-found")
        else:
            found = sets.select("set_key", F.col("id").alias("component"))
        component = F.coalesce("component", "doc_id")
        return rows.join(found, "set_key", "left").select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))
