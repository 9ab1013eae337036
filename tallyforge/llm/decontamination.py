"""Benchmark decontamination by size-partitioned containment search (operator 7).

Test items are partitioned by their number of shingles, so that the windows of
a long document which a partition searches are of its items' order of size: a
short item is then a sizeable part of some window instead of a vanishing part
of the document, and MinHash can see it. Windows and items are sketched by
one-permutation MinHash (the least hash per bin); an item and a window that
agree in a bin make their document a candidate, which is verified by the exact
share of the item's shingles that the whole document contains. The shortest
items have too few values for that: a document that has any of their shingles
is a candidate. An item of fewer words than a shingle is looked up as the run
of words that it is.

A shingle with a word that no item has is in no item. So a document's words are
looked up in the items' vocabulary, and only runs of its words are hashed; what
is left out of a sketch could not have agreed, and candidates become no fewer.

Items are taken in blocks of a bounded number of rows and bytes, one pass over
the documents per block; nothing else is broadcast, and documents are never
shuffled. (Sketching the documents once and joining the sketches with the items'
would shuffle about two hashes for each word of the corpus, several times its
size, and is dearer than ten passes.)
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.minhash import sliced
from tallyforge.llm.storage import bound_batches, lean, stored
from tallyforge.llm.texthash import NOT_WORD, distinct, known_words, mix, shared, shingles_of, words

SCHEMA = "doc_id long, item_id long, n_item_shingles long, n_shared long, containment double"
#: largest number of shingles of each partition's items, and bins of its sketches
SMALLEST, STEP = 16, 4
#: shingles that are sketched at once
SEGMENT = 1 << 15


def bins_of(size: int) -> int:
    """Many bins for small items, so that few shingles share one."""
    return 1024 if size <= 16 else 256 if size <= 64 else 128


def partition_of(n: int) -> int:
    size = SMALLEST
    while size < n:
        size *= STEP
    return size


def sketch_parts(h: np.ndarray, bins: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and value of each shingle."""
    y = mix(h ^ np.uint64(0x5BD1E9955BD1E995))
    return ((y >> np.uint64(40)) * np.uint64(bins) >> np.uint64(24)).astype(np.int64), mix(y)


@dataclass
class Values:
    """Sorted hashes, and the items that have each."""

    values: np.ndarray
    owners: np.ndarray
    begins: np.ndarray
    maybe: np.ndarray  # by the last 16 bits

    @classmethod
    def of(cls, values: list[np.ndarray], items: list[int]) -> Values:
        owners = np.repeat(np.array(items, np.int32), [len(v) for v in values])
        flat = np.concatenate(values)
        order = np.argsort(flat, kind="stable")
        found, begins = np.unique(flat[order], return_index=True)
        maybe = np.zeros(1 << 16, bool)
        maybe[(found & np.uint64(0xFFFF)).astype(np.int64)] = True
        return cls(found, owners[order], np.append(begins, len(flat)), maybe)

    def hits(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the hashes are among the values, and where."""
        k = np.flatnonzero(self.maybe[(h & np.uint64(0xFFFF)).astype(np.int64)])
        place = np.searchsorted(self.values, h[k])
        same = (place < len(self.values)) & (self.values[np.minimum(place, len(self.values) - 1)] == h[k])
        return k[same], place[same]

    def items(self, place: int) -> list[int]:
        return self.owners[self.begins[place] : self.begins[place + 1]].tolist()


@dataclass
class Found:
    """The shingles of some documents that have only words of items, by document and place."""

    doc: np.ndarray
    place: np.ndarray
    h: np.ndarray  # both lanes
    counts: np.ndarray  # shingles of each document, these and others

    def of(self, d: int) -> slice:
        return slice(*np.searchsorted(self.doc, [d, d + 1]))

    @classmethod
    def all(cls, h: np.ndarray, counts: np.ndarray) -> Found:
        """Documents of which every shingle is there; ``h`` is one lane."""
        place = np.arange(len(h)) - np.repeat(np.cumsum(counts) - counts, counts)
        return cls(np.repeat(np.arange(len(counts)), counts), place, h[:, None], counts)


@dataclass
class ItemIndex:
    """One block of items, sketched; what a task carries."""

    ids: list[int | None] = field(default_factory=list)
    sets: list[np.ndarray] = field(default_factory=list)
    vocabulary: dict[bytes, int] = field(default_factory=dict)
    hashes: np.ndarray = field(default_factory=lambda: np.empty((0, 2), np.uint64))  # of the vocabulary
    sketches: dict[int, Values] = field(default_factory=dict)  # by partition
    short: dict[int, Values] = field(default_factory=dict)  # items of fewer words than a shingle, by their number of words

    @classmethod
    def build(cls, items: list[tuple[int | None, str | None]], size: int) -> ItemIndex:
        out, texts = cls(), [(t or "").encode("utf-8", "surrogatepass") for _, t in items]
        for t in texts:
            for word in t.translate(NOT_WORD).split():
                out.vocabulary.setdefault(word, len(out.vocabulary))
        out.hashes = words(list(out.vocabulary), NOT_WORD)[0]
        numbers, n_words = known_words(texts, out.vocabulary, NOT_WORD)
        h, counts = shingles_of(out.hashes[numbers], n_words, size)
        at, found, short = 0, {}, {}
        for (item_id, _), n, length in zip(items, counts, n_words, strict=True):
            s = distinct(h[at : at + n])
            at += n
            if not len(s):
                continue
            if length < size:
                group, values = short.setdefault(int(length), ([], [])), s[:, 0]
            else:
                part = partition_of(len(s))
                b, v = sketch_parts(s[:, 0], bins_of(part))
                least = np.full(bins_of(part), np.uint64(0xFFFFFFFFFFFFFFFF))
                np.minimum.at(least, b, v)
                # a sketch of the shortest items might be of one value, so all their shingles are kept
                group, values = found.setdefault(part, ([], [])), v if part == SMALLEST else least[np.unique(b)]
            group[0].append(values)
            group[1].append(len(out.ids))
            out.ids.append(item_id)
            out.sets.append(s)
        out.sketches = {part: Values.of(*group) for part, group in found.items()}
        out.short = {length: Values.of(*group) for length, group in short.items()}
        return out

    def shingles(self, numbers: np.ndarray, n_words: np.ndarray, size: int) -> Found:
        """The shingles of ``size`` words of documents whose words are ``numbers`` of the vocabulary."""
        known = np.concatenate([[0], np.cumsum(numbers >= 0)])
        counts = np.maximum(n_words - size + 1, 0)
        first = np.cumsum(n_words) - n_words
        doc = np.repeat(np.arange(len(counts)), counts)
        place = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts)
        start = first[doc] + place
        whole = known[start + size] - known[start] == size
        doc, place, start = doc[whole], place[whole], start[whole]
        at = (start[:, None] + np.arange(size)).ravel()
        h, _ = shingles_of(self.hashes[numbers[at]], np.full(len(start), size), size)
        return Found(doc, place, h, counts)

    def runs(self, numbers: np.ndarray, n_words: np.ndarray) -> Iterator[tuple[int, int]]:
        """(document, item) pairs of which the document has the item's words in a row, for items shorter than a shingle."""
        for length, index in self.short.items():
            s = self.shingles(numbers, n_words, length)
            found: set[tuple[int, int]] = set()
            for k, place in zip(*index.hits(s.h[:, 0]), strict=True):
                found.update((int(s.doc[k]), item) for item in index.items(place) if (self.sets[item][0] == s.h[k]).all())
            yield from found

    def candidates(self, h: np.ndarray, counts: np.ndarray) -> set[tuple[int, int]]:
        """``pairs`` of documents of which every shingle is given."""
        return self.pairs(Found.all(h, counts))

    def pairs(self, s: Found) -> set[tuple[int, int]]:
        """(document, item) pairs of which a window and the item agree in a bin.

        Documents are taken together up to ``SEGMENT`` shingles; a longer one is
        taken in segments that overlap by a window, so memory stays bounded.
        """
        overlap = 2 * max(self.sketches, default=0)
        segment = max(SEGMENT, overlap)
        found: set[tuple[int, int]] = set()
        d, counts = 0, s.counts
        while d < len(counts):
            if counts[d] > segment:
                own = s.of(d)
                place, h = s.place[own], s.h[own, 0]
                for a in range(0, int(counts[d]), segment):
                    begin, end = max(0, a - overlap), min(int(counts[d]), a + segment)
                    i, j = np.searchsorted(place, [begin, end])
                    found.update((d, item) for _, item in self._meeting(np.zeros(j - i, np.int64), place[i:j] - begin, h[i:j], np.array([end - begin])))
                d += 1
                continue
            e = d + max(1, int(np.searchsorted(np.cumsum(counts[d:]), segment, side="right")))
            own = slice(*np.searchsorted(s.doc, [d, e]))
            found.update((d + k, item) for k, item in self._meeting(s.doc[own] - d, s.place[own], s.h[own, 0], counts[d:e]))
            d = e
        return found

    def _agreeing(self, h: np.ndarray, counts: np.ndarray) -> set[tuple[int, int]]:
        s = Found.all(h, counts)
        return self._meeting(s.doc, s.place, h, counts)

    def _meeting(self, doc: np.ndarray, position: np.ndarray, h: np.ndarray, counts: np.ndarray) -> set[tuple[int, int]]:
        found: set[tuple[int, int]] = set()
        if not len(h):
            return found
        for size, index in self.sketches.items():
            bins = bins_of(size)
            b, v = sketch_parts(h, bins)
            per_doc = counts // size + 2  # windows of 2 * size shingles that begin every size shingles
            first = np.cumsum(per_doc) - per_doc
            own = first[doc] + position // size + 1
            k, place = index.hits(v)
            if not len(k):
                continue
            if size > SMALLEST:
                least = np.full(int(per_doc.sum()) * bins, np.uint64(0xFFFFFFFFFFFFFFFF))
                for window in (own, own - 1):
                    np.minimum.at(least, window * bins + b, v)
                agrees = (least[own[k] * bins + b[k]] == v[k]) | (least[(own[k] - 1) * bins + b[k]] == v[k])
                k, place = k[agrees], place[agrees]
            for d, p in zip(doc[k].tolist(), place.tolist(), strict=True):
                found.update((d, item) for item in index.items(p))
        return found


def _search(index: ItemIndex, size: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in sliced(batches, 1 << 18):
            numbered = known_words(texts, index.vocabulary, NOT_WORD)
            s = index.shingles(*numbered, size)
            rows, sets = [], {}
            for d, item in sorted(index.pairs(s)):
                if d not in sets:
                    sets = {d: distinct(s.h[s.of(d)])}
                wanted = index.sets[item]
                both = shared(wanted, sets[d])
                if 100 * both >= percent * len(wanted):
                    rows.append((ids[d], index.ids[item], len(wanted), both, both / len(wanted)))
            rows += [(ids[d], index.ids[item], 1, 1, 1.0) for d, item in index.runs(*numbered)]
            if rows:
                kinds = [pa.int64()] * 4 + [pa.float64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["doc_id", "item_id", "n_item_shingles", "n_shared", "containment"])

    return run


def contaminated(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", words: int = 5, percent: int = 80, block_rows: int = 200_000, block_bytes: int = 32 << 20) -> DataFrame:
    """One row per (document, item) of which the document holds ``percent`` of the item's shingles.

    Words are runs of ASCII letters, digits and non-ASCII characters, with A-Z
    in lower case. An item of fewer words than a shingle is one shingle, held
    by a document that has its words in a row. An item or document without
    words (or null) matches nothing. Repeated rows of either table give
    repeated result rows. Other columns are not read. An empty table gives no
    rows. A task holds about ``block_rows`` items or ``block_bytes`` of their
    texts at once (and about seven times these bytes of hashes); more items make
    more passes.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    items = benchmark.select(F.col(item_id_col).cast("long").alias("item_id"), F.col(item_text_col).alias("item_text"))
    n, size = items.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("item_text")), F.lit(0))).first()
    blocks = max(1, -(-n // block_rows), -(-size // block_bytes))
    numbered = items if blocks == 1 else stored(items.withColumn("block", F.pmod(F.xxhash64("item_id", "item_text"), F.lit(blocks))), "benchmark")
    out: DataFrame | None = None
    for k in range(blocks):
        part = numbered if blocks == 1 else numbered.where(F.col("block") == k)
        index = ItemIndex.build([(r.item_id, r.item_text) for r in part.select("item_id", "item_text").toLocalIterator()], words)
        found = source.mapInArrow(lean(_search(index, words, percent)), SCHEMA)
        out = found if out is None else out.unionByName(found)
    return out if out is not None else spark.createDataFrame([], SCHEMA)


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", **options) -> DataFrame:
    """The documents, all columns, without those that hold an item; null ids stay."""
    hits = stored(contaminated(docs, benchmark, id_col=id_col, **options).select(F.col("doc_id").alias("_hit_id")).distinct(), "decontaminate-hits")
    return docs.join(hits, docs[id_col] == hits["_hit_id"], "left_anti")
