"""Language identification as inference of a mixture (operator 8).

A document's byte trigrams are a mixture of the learned languages' trigram
distributions. Expectation-maximisation estimates the proportions; the number
of languages is the one whose penalised likelihood is best, with the languages
taken in the order of their proportions. The prediction is the largest share.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.minhash import sliced
from tallyforge.llm.storage import bound_batches, lean
from tallyforge.llm.texthash import LOWER

UNKNOWN = "und"
SCHEMA = "doc_id long, lang_pred string, score double, languages array<struct<lang:string,share:double>>"

_SPACED = LOWER.copy()
for _b in range(128):
    if not chr(_b).isalpha():
        _SPACED[_b] = 0x20


def has_letter(text: str) -> bool:
    """Whether any character is a letter (general category L; numerals and marks are none)."""
    return any(map(str.isalpha, text))


def bucket_of(code: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of each trigram code (unsigned 32-bit); at most 65,536 buckets."""
    h = code * np.uint32(0x9E3779B1)
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x85EBCA6B)
    return ((h >> np.uint32(16)) * np.uint32(buckets) >> np.uint32(16)).astype(np.int32)


def trigrams(texts: list[bytes], buckets: int, context: list[tuple[int, int]] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each byte trigram of each text, and the text it is of.

    Letters count, in lower case (ASCII and Latin-1); all else is a space, and
    trigrams of which the middle is a space are left out. ``context`` is how
    many bytes at the begin and end of each text are only neighbours: no
    trigram with such a middle counts.
    """
    sizes = np.fromiter((len(t) for t in texts), np.int64, len(texts))
    data = _SPACED[np.frombuffer(b" " + b"  ".join(texts) + b"  ", np.uint8)]
    upper = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)
    data[1:][upper] += 0x20
    keep = data[1:-1] != 0x20  # the middle of trigram i is byte i + 1
    begins = np.cumsum(sizes + 2) - (sizes + 2)
    for at, size, (head, tail) in zip(begins, sizes, context or (), strict=False):
        keep[at : at + head] = False
        keep[at + size - tail : at + size] = False
    at = np.flatnonzero(keep)
    code = (data[at].astype(np.uint32) << np.uint32(16)) | (data[at + 1].astype(np.uint32) << np.uint32(8)) | data[at + 2]
    return bucket_of(code, buckets), (np.searchsorted(begins, at, side="right") - 1).astype(np.int32)


def pieces(texts: list[bytes], most: int = 1 << 18) -> Iterator[tuple[np.ndarray, list[bytes], list[tuple[int, int]]]]:
    """The texts in groups of about ``most`` bytes: the index of each, the bytes, and their context.

    A longer text is cut anywhere; each part has two bytes before it and one
    after it as context, so that the parts have the whole text's trigrams.
    """
    owners, group, context, size = [], [], [], 0
    for k, text in enumerate(texts):
        for at in range(0, max(len(text), 1), most):
            to = min(at + most, len(text))
            head, tail = min(at, 2), min(len(text) - to, 1)
            owners.append(k)
            group.append(text[at - head : to + tail])
            context.append((head, tail))
            size += to - at
            if size >= most:
                yield np.array(owners), group, context
                owners, group, context, size = [], [], [], 0
    if group:
        yield np.array(owners), group, context


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    log_p: np.ndarray  # buckets x languages, float32
    buckets: int


def _count(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}

        for langs, texts in sliced(batches):
            names = np.array(langs, object)
            for of, group, context in pieces(texts):
                codes, owner = trigrams(group, buckets, context)
                for lang in set(langs):
                    mine = (names == lang)[of][owner]
                    counts.setdefault(lang, np.zeros(buckets, np.int64))
                    counts[lang] += np.bincount(codes[mine], minlength=buckets)
        for lang, c in counts.items():
            some = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(some)), pa.array(some, pa.int32()), pa.array(c[some], pa.int64())], names=["lang", "bucket", "n"])

    return run


def train(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", buckets: int = 1 << 13, smoothing: float = 0.5, most_languages: int = 256) -> LanguageModel:
    """Trigram distributions of each label, counted over all rows given.

    The model holds ``buckets`` numbers for each language; more than
    ``most_languages`` labels raise ValueError. Null labels are left out.
    """
    bound_batches(docs.sparkSession)
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    counted = rows.mapInArrow(lean(_count(buckets)), "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    per = counted.groupBy("lang").agg(F.collect_list(F.struct("bucket", "n")).alias("cells")).orderBy("lang").limit(most_languages + 1).collect()
    if len(per) > most_languages:
        raise ValueError(f"more than {most_languages} languages")
    p = np.full((buckets, len(per)), smoothing)
    for k, row in enumerate(per):
        for cell in row.cells:
            p[cell.bucket, k] += cell.n
    return LanguageModel(tuple(r.lang for r in per), np.log(p / p.sum(axis=0)).astype(np.float32) if per else p.astype(np.float32), buckets)


def _em(p: np.ndarray, c: np.ndarray, starts: np.ndarray, doc: np.ndarray, share: np.ndarray, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """Proportions after ``steps`` of EM and their log-likelihoods, of all documents at once."""
    total = np.add.reduceat(c, starts)[:, None]
    for _ in range(steps):
        joint = p * share[doc]
        joint *= (c / np.maximum(joint.sum(axis=1), 1e-30))[:, None]
        share = np.add.reduceat(joint, starts, axis=0) / total
    return share, np.add.reduceat(c * np.log(np.maximum((p * share[doc]).sum(axis=1), 1e-30)), starts)


def mixtures(model: LanguageModel, texts: list[bytes], steps: int = 12, penalty: float = 2.0) -> tuple[np.ndarray, np.ndarray]:
    """Per text its proportions (0 outside the selected set), and whether it has trigrams."""
    n, k = len(texts), len(model.languages)
    share = np.zeros((n, k), np.float32)
    dense = np.zeros(n * model.buckets, np.int64)
    for of, group, context in pieces(texts):
        codes, owner = trigrams(group, model.buckets, context)
        dense += np.bincount(of[owner] * np.int64(model.buckets) + codes, minlength=len(dense))
    some = dense.reshape(n, model.buckets).any(axis=1)
    if not some.any() or not k:
        return share, some
    cells = np.flatnonzero(dense)
    doc_of, c = cells // model.buckets, dense[cells].astype(np.float32)
    index = np.cumsum(some) - 1  # documents that have trigrams
    doc = index[doc_of]
    starts = np.flatnonzero(np.diff(np.concatenate([[-1], doc])))
    log_p = model.log_p[cells % model.buckets]
    p = np.exp(log_p)
    singles = np.add.reduceat(c[:, None] * log_p, starts, axis=0)
    best = np.zeros(singles.shape, np.float32)
    best[np.arange(len(best)), singles.argmax(axis=1)] = 1
    total = np.add.reduceat(c, starts)
    # neighbouring trigrams overlap: a third of them count as independent
    value = singles.max(axis=1) / 3
    if k > 1:
        full, full_ll = _em(p, c, starts, doc, np.full(singles.shape, 1 / k, np.float32), steps)
        order = np.argsort(-full, axis=1, kind="stable")
        # no proportions of any languages have a likelihood above this (concavity; the rest is for rounding)
        gain = np.add.reduceat(p * (c / np.maximum((p * full[doc]).sum(axis=1), 1e-30))[:, None], starts, axis=0).max(axis=1) / total
        most = full_ll + total * np.log(np.maximum(gain, 1)) + 1e-4 * np.abs(full_ll) + 1
        for size in range(2, k + 1):
            cost = penalty * (size - 1) * np.log(total + 1)
            left = np.flatnonzero(most / 3 - cost > value)  # larger sets cannot be better for the others
            if not len(left):
                break
            of_left = np.isin(doc, left)
            mine = np.searchsorted(left, doc[of_left])
            within = np.zeros((len(left), k), bool)
            np.put_along_axis(within, order[left, :size], True, axis=1)
            begin = np.where(within, np.maximum(full[left], 1e-3), 0).astype(np.float32)
            begins = np.flatnonzero(np.diff(np.concatenate([[-1], mine])))
            got, ll = _em(p[of_left], c[of_left], begins, mine, begin / begin.sum(axis=1, keepdims=True), steps // 2)
            penalised = ll / 3 - cost[left]
            better = penalised > value[left]
            value[left[better]] = penalised[better]
            best[left[better]] = got[better]
    share[some] = best
    return share, some


def _predict(model: LanguageModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array(model.languages, object)
        # a slice's arrays are of its different trigrams times the languages
        rows = max(1, min(128, 1024 // max(len(names), 1)))
        for ids, texts in sliced(batches, 1 << 18, rows):
            share, some = mixtures(model, texts)
            preds, scores, sets = [], [], []
            for k, t in enumerate(texts):
                if some[k] and len(names) and has_letter(t.decode("utf-8", "replace")):
                    top = int(share[k].argmax())
                    preds.append(names[top])
                    scores.append(min(1.0, float(share[k][top])))
                    sets.append([{"lang": names[j], "share": min(1.0, float(share[k][j]))} for j in np.argsort(-share[k], kind="stable") if share[k][j] > 0])
                else:
                    preds.append(UNKNOWN)
                    scores.append(0.0)
                    sets.append([])
            kind = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(preds, pa.string()), pa.array(scores, pa.float64()), pa.array(sets, kind)], names=["doc_id", "lang_pred", "score", "languages"])

    return run


def held_out(id_col: str) -> F.Column:
    """crc32 of the id as text, modulo 4, is 2; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("long").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, model: LanguageModel, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, lang_pred, score (its share), languages.

    ``und`` with score 0 where the text is null or has no letter, or no
    language was learned. Repeated rows and null ids give a row each; ties
    take the first language in alphabetical order. Other columns are not read.
    """
    bound_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(lean(_predict(model)), SCHEMA)


def _keep(model: LanguageModel, text_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predict = _predict(model)
        for batch in batches:
            rows = pa.RecordBatch.from_arrays([pa.array(range(batch.num_rows), pa.int64()), batch[text_at]], names=["doc_id", "text"])
            known = [p != UNKNOWN for found in predict(iter([rows])) for p in found["lang_pred"].to_pylist()]
            yield batch.filter(pa.array(known, pa.bool_()))

    return run


def identified(docs: DataFrame, model: LanguageModel, *, text_col: str = "text") -> DataFrame:
    """The rows, all columns, whose language is not ``und``; nothing is shuffled."""
    bound_batches(docs.sparkSession)
    return docs.mapInArrow(lean(_keep(model, docs.columns.index(text_col))), docs.schema)
