"""Toxicity of texts by a small convolutional network over hashed words."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwright.llm import language
from tillwright.llm.common import settle

# Buckets of the embedding; bucket 0 stands for nothing.
BUCKETS = 1 << 16
# A word is known by itself, its first 3, 4 and 5 letters and its last 3.
_STARTS, _ENDS = (3, 4, 5), (3,)
FEATURES = 1 + len(_STARTS) + len(_ENDS)
# Words a filter looks at, filters of each width, numbers per bucket.
WIDTHS = (1, 2, 3)
FILTERS = 8
DEPTH = 16
_PAD = max(WIDTHS) - 1
# A text is predicted toxic from this score on; the threshold of its language has it.
DECIDED = 0.7
# A share of clean texts above a threshold weighs as much as so many of toxic texts below it.
_CLEAN_WEIGHT = 3
# Letters and words worked on at a time.
_CHARS, _WORDS = 1 << 20, 1 << 16
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _B
    return x ^ (x >> np.uint64(29))


def _bucket(sums: np.ndarray, kind: int) -> np.ndarray:
    hashed = _mixed((sums + np.uint64(kind)) * _A)
    return (hashed >> np.uint64(24)).astype(np.int64) % (BUCKETS - 1) + 1


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """``(ids, doc)``: a row of buckets for each place of the texts, and its text's number.

    Words are runs of letters in lower case. Each text ends in places without a word,
    so that filters see its last words; a text without words has one place more.
    """
    codes = language.letters()[np.frombuffer("\n".join([*texts, ""]).encode("utf-32-le"), np.uint32)]
    ends_of_texts = np.cumsum([len(t) + 1 for t in texts])
    inside = codes != 0
    edge = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    size = ends - starts
    # Sums of letters mixed with their place from the word's start, or end, tell words apart.
    at = np.arange(len(codes), dtype=np.int64)
    word = np.cumsum(np.concatenate(([False], inside[1:] & ~inside[:-1]))) + (inside[:1].sum() - 1)
    sums = []
    for anchor, lengths in ((starts, (*_STARTS, None)), (ends, _ENDS)):
        place = at[inside] - anchor[word[inside]]
        mixed = np.zeros(len(codes) + 1, np.uint64)
        mixed[1:][inside] = _mixed(
            codes[inside].astype(np.uint64) * _A + place.astype(np.uint64) * _B)
        total = np.cumsum(mixed)
        for length in lengths:
            if length is None:
                part, long = total[ends] - total[starts], True
            elif anchor is starts:
                part, long = total[np.minimum(starts + length, ends)] - total[starts], size > length
            else:
                part, long = total[ends] - total[np.maximum(ends - length, starts)], size > length
            sums.append(np.where(long, _bucket(part, len(sums) + 1), 0))
    doc = np.searchsorted(ends_of_texts, starts, side="right")
    held = np.bincount(doc, minlength=len(texts))
    places = np.maximum(held, 1) + _PAD
    first = np.cumsum(places) - places
    ids = np.zeros((int(places.sum()), FEATURES), np.int32)
    ids[np.arange(len(doc)) - np.repeat(np.cumsum(held) - held, held) + first[doc]] = np.stack(
        sums, axis=1) if len(doc) else 0
    return ids, np.repeat(np.arange(len(texts)), places)


def _starts_of(doc: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])))


@dataclass
class Network:
    """Embeddings summed per word, filters of several widths, the greatest of each, a sum."""

    table: np.ndarray  # buckets x depth
    filters: dict[int, np.ndarray]  # width -> width x depth x filters
    offset: dict[int, np.ndarray]
    out: np.ndarray
    bias: float
    _projected: np.ndarray | None = field(default=None, repr=False)

    @staticmethod
    def fresh(seed: int) -> Network:
        rng = np.random.default_rng(seed)
        return Network(
            np.zeros((BUCKETS, DEPTH), np.float32),
            {w: (rng.normal(size=(w, DEPTH, FILTERS)) / np.sqrt(DEPTH * w)).astype(np.float32)
             for w in WIDTHS},
            {w: np.zeros(FILTERS, np.float32) for w in WIDTHS},
            (rng.normal(size=len(WIDTHS) * FILTERS) * 0.3).astype(np.float32), 0.0,
        )

    def projected(self) -> np.ndarray:
        """Per bucket what it adds to each filter at each of its places; computed once."""
        if self._projected is None:
            self._projected = np.concatenate(
                [self.table @ self.filters[w][k] for w in WIDTHS for k in range(w)], axis=1)
        return self._projected

    def pooled(self, ids: np.ndarray, doc: np.ndarray, texts: int) -> np.ndarray:
        """The greatest answer of each filter in each text, some thousand places at a time."""
        table = self.projected()
        most = np.full((texts, len(WIDTHS) * FILTERS), -np.inf, np.float32)
        for start in range(0, len(ids), _WORDS):
            own = ids[start : start + _WORDS + _PAD]
            n = min(_WORDS, len(ids) - start)
            parts = table[own[:, 0]]
            for k in range(1, FEATURES):
                parts += table[own[:, k]]
            column, answers = 0, []
            for w in WIDTHS:
                total = np.zeros((n, FILTERS), np.float32)
                for k in range(w):
                    shifted = parts[k : k + n, column : column + FILTERS]
                    total[: len(shifted)] += shifted
                    column += FILTERS
                answers.append(total + self.offset[w])
            answers = np.concatenate(answers, axis=1)
            here = doc[start : start + n]
            # Places after the last word see into the next text, so they are no start.
            last = np.concatenate((doc[start + _PAD : start + n + _PAD], np.full(_PAD, -1)))[:n]
            answers[last != here] = -np.inf
            first = _starts_of(here)
            block = np.maximum.reduceat(answers, first, axis=0)
            most[here[first]] = np.maximum(most[here[first]], block)
        return np.maximum(most, 0)

    def logits(self, texts: list[str]) -> np.ndarray:
        ids, doc = features(texts)
        return self.pooled(ids, doc, len(texts)) @ self.out + self.bias


class _Adam:
    def __init__(self, rate: float):
        self.rate, self.state, self.step = rate, {}, 0

    def move(self, name: str, value: np.ndarray, gradient: np.ndarray) -> None:
        m, v = self.state.setdefault(name, (np.zeros_like(value), np.zeros_like(value)))
        m += 0.1 * (gradient - m)
        v += 0.01 * (gradient * gradient - v)
        t = self.step
        value -= self.rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-7)


def _log_odds(ids: list[np.ndarray], toxic: np.ndarray) -> np.ndarray:
    """Per bucket how much likelier a toxic text holds it, drawn to 0 where texts are few."""
    counts = np.zeros((2, BUCKETS))
    for own, label in zip(ids, toxic):
        counts[int(label), np.unique(own)] += 1
    sizes = np.array([[max(1, (~toxic).sum())], [max(1, toxic.sum())]])
    share = (counts + 0.5) / (sizes + 1)
    seen = counts.sum(axis=0)
    odds = np.log(share[1] / share[0]) * seen / (seen + 5)
    odds[0] = 0
    return np.where(seen > 0, odds, 0).astype(np.float32)


def fit(ids: list[np.ndarray], toxic: np.ndarray, epochs: int = 6, batch: int = 32,
        seed: int = 7) -> Network:
    """Train by gradient steps; the first numbers of the embedding start as log odds."""
    net, rng = Network.fresh(seed), np.random.default_rng(seed)
    odds = _log_odds(ids, toxic)
    seen = odds != 0
    net.table[seen] = rng.normal(size=(int(seen.sum()), DEPTH)).astype(np.float32) * 0.02
    net.table[:, 0] = odds / 4
    for w in WIDTHS:
        net.filters[w][:, 0, :] = np.abs(net.filters[w][:, 0, :]) + 0.3 / w
    net.out[:] = np.abs(net.out) + 0.1
    weight = {True: 0.5 / max(1, toxic.sum()), False: 0.5 / max(1, (~toxic).sum())}
    adam = _Adam(0.01)
    for _ in range(epochs):
        order = rng.permutation(len(ids))
        for at in range(0, len(order), batch):
            chosen = order[at : at + batch]
            _step(net, adam, [ids[i] for i in chosen], toxic[chosen],
                  np.array([weight[bool(toxic[i])] for i in chosen]) * len(ids) / len(chosen))
    net._projected = None
    return net


def _step(net: Network, adam: _Adam, ids: list[np.ndarray], toxic: np.ndarray,
          weight: np.ndarray) -> None:
    doc = np.repeat(np.arange(len(ids)), [len(i) for i in ids])
    ids = np.concatenate(ids)
    words = net.table[ids].sum(axis=1)
    first = _starts_of(doc)
    sizes = np.diff(np.append(first, len(doc)))
    pooled, where = [], {}
    for w in WIDTHS:
        n = len(words) - w + 1
        answers = np.full((len(words), FILTERS), -np.inf, np.float32)
        answers[:n] = sum(words[k : k + n] @ net.filters[w][k] for k in range(w))
        last = np.append(doc[_PAD:], np.full(_PAD, -1))
        answers[last != doc] = -np.inf
        most = np.maximum.reduceat(answers, first, axis=0)
        # The first place of each text that has the greatest answer.
        at_most = answers == np.repeat(most, sizes, axis=0)
        places = np.where(at_most, np.arange(len(words))[:, None], len(words))
        where[w] = np.minimum.reduceat(places, first, axis=0)
        pooled.append(np.maximum(most + net.offset[w], 0))
    pooled = np.concatenate(pooled, axis=1)
    logits = pooled @ net.out + net.bias
    error = ((1 / (1 + np.exp(-logits)) - toxic) * weight).astype(np.float32)
    adam.step += 1
    back = error[:, None] * net.out * (pooled > 0)
    rows, table_gradient = [], np.zeros_like(net.table)
    for j, w in enumerate(WIDTHS):
        own = back[:, j * FILTERS : (j + 1) * FILTERS]
        gradient = np.zeros_like(net.filters[w])
        for f in range(FILTERS):
            live = np.flatnonzero(own[:, f])
            for k in range(w):
                at = where[w][live, f] + k
                gradient[k, :, f] = own[live, f] @ words[at]
                change = own[live, f, None] * net.filters[w][k, :, f]
                for kind in range(FEATURES):
                    np.add.at(table_gradient, ids[at, kind], change)
        rows.append((w, gradient, own.sum(axis=0)))
    adam.move("out", net.out, pooled.T @ error + 1e-4 * net.out)
    net.bias -= adam.rate * float(error.sum())
    for w, gradient, offset in rows:
        adam.move(f"filters-{w}", net.filters[w], gradient + 1e-4 * net.filters[w])
        adam.move(f"offset-{w}", net.offset[w], offset)
    table_gradient[0] = 0
    touched = np.flatnonzero(table_gradient.any(axis=1))
    _move_rows(net.table, table_gradient, touched, adam)


def _move_rows(table: np.ndarray, gradient: np.ndarray, touched: np.ndarray, adam: _Adam) -> None:
    """Only rows with a gradient move, each by its own history."""
    history = adam.state.setdefault("table", np.zeros(len(table), np.float32))
    own = gradient[touched]
    history[touched] += (own * own).mean(axis=1)
    table[touched] -= 0.05 * own / (np.sqrt(history[touched])[:, None] + 1e-6)


@dataclass
class Model:
    """A network, the languages it knows, and the threshold of each."""

    network: Network | None
    languages: language.Model
    thresholds: dict[str, float]
    default: float
    # Ids of the texts that trained the network.
    learned: list = field(default_factory=list, repr=False)

    def scores(self, texts: list[str]) -> np.ndarray:
        if self.network is None:
            return np.zeros(len(texts))
        limits = [self.thresholds.get(name, self.default)
                  for name, _ in self.languages.predict_all(texts)]
        away = self.network.logits(texts).astype(np.float64) - np.array(limits)
        return 1 / (1 + np.exp(-np.clip(away + np.log(DECIDED / (1 - DECIDED)), -30, 30)))


def _threshold(logits: np.ndarray, toxic: np.ndarray, texts: np.ndarray) -> float:
    """The middle of the gap that tells texts apart best; a clean one taken for toxic counts more."""
    order = np.argsort(logits)
    sorted_logits, label, n = logits[order], toxic[order], texts[order]
    below = (_CLEAN_WEIGHT * np.cumsum(n * ~label) / max(1, (n * ~label).sum())
             - np.cumsum(n * label) / max(1, (n * label).sum()))
    # Nothing comes between equal ones.
    below[:-1][np.diff(sorted_logits) == 0] = -np.inf
    best = int(np.argmax(below))
    after = sorted_logits[best + 1] if best + 1 < len(logits) else sorted_logits[best] + 1
    return float((sorted_logits[best] + after) / 2)


def _calibrated(logits: np.ndarray, toxic: np.ndarray, languages: list[str],
                texts: np.ndarray | None = None) -> tuple[dict, float]:
    """A threshold per language, drawn to that of all texts where toxic texts are few.

    ``texts`` says how many texts each entry stands for, one unless told otherwise.
    """
    if not toxic.any() or toxic.all():
        return {}, 0.0
    texts = np.ones(len(logits), np.int64) if texts is None else texts
    default = _threshold(logits, toxic, texts)
    names, found = np.array(languages), {}
    for name in sorted(set(languages)):
        own = names == name
        n = min(int(texts[own & toxic].sum()), int(texts[own & ~toxic].sum()))
        if n:
            share = n / (n + 10)
            found[name] = share * _threshold(logits[own], toxic[own], texts[own]) + (1 - share) * default
    return found, default


def _marked(labels: DataFrame, doc_id: str, label: str) -> DataFrame:
    return labels.where(F.col(f"`{label}`").isNotNull() & F.col(f"`{doc_id}`").isNotNull()).groupBy(
        F.col(f"`{doc_id}`").alias("doc_id")).agg(F.max(F.col(f"`{label}`") > 0).alias("toxic"))


def sample(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
           lang: str = "lang", label: str = "toxic", most: int = 3000,
           longest: int = 10_000) -> DataFrame:
    """``(doc_id, text, lang, toxic)`` of the texts to learn from.

    Of each label the ``most`` ids with the least hash, with texts of up to ``longest``
    letters: 60 MB at most with the defaults, whatever the tables hold. An id is toxic if any of
    its label rows says so; of its documents any may be taken.
    """
    marked = _marked(labels, doc_id, label)
    chosen = None
    for value in (True, False):
        own = marked.where(F.col("toxic") == value).orderBy(
            F.xxhash64(F.col("doc_id").cast("string")), "doc_id").limit(most)
        chosen = own if chosen is None else chosen.union(own)
    plain = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"),
                        F.col(f"`{lang}`").cast("string").alias("lang"))
    short = plain.where(F.length("text") <= longest)
    found = short.join(F.broadcast(settle(chosen, "sample-ids")), "doc_id")
    one = found.groupBy("doc_id").agg(F.min_by(F.struct("text", "lang", "toxic"), F.struct("text", "lang")).alias("r"))
    return settle(one.select("doc_id", "r.*"), "sample")


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
          lang: str = "lang", label: str = "toxic", most: int = 3000,
          longest: int = 10_000) -> Model:
    """Fit on a bounded sample of the rows of ``labels``; see ``sample``.

    Three quarters of it train the network, the last sets the thresholds: one per
    language, told from the text by n-grams learned from the same sample. Without
    texts of both labels the model scores every text 0.
    """
    chosen = sample(docs, labels, doc_id, text, lang, label, most, longest)
    rows = chosen.orderBy("doc_id").collect()
    languages = language.train(chosen)
    toxic = np.array([r.toxic for r in rows], bool)
    if not toxic.any() or toxic.all():
        return Model(None, languages, {}, 0.0)
    texts = [r.text for r in rows]
    kept_back = np.zeros(len(rows), bool)
    for value in (False, True):
        kept_back[np.flatnonzero(toxic == value)[3::4]] = True
    learned = [i for i in range(len(rows)) if not kept_back[i]]
    network = fit([features([texts[i]])[0] for i in learned], toxic[learned])
    judged = np.flatnonzero(kept_back) if toxic[kept_back].any() else np.arange(len(rows))
    logits = np.concatenate([network.logits([texts[i]]) for i in judged])
    names = [name for name, _ in languages.predict_all([texts[i] for i in judged])]
    return Model(network, languages, *_calibrated(logits, toxic[judged], names),
                 [rows[i].doc_id for i in learned])


def _blocks(texts: list[str]) -> Iterator[list[str]]:
    block, size = [], 0
    for text in texts:
        if block and size + len(text) > _CHARS:
            yield block
            block, size = [], 0
        block.append(text)
        size += len(text)
    if block:
        yield block


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, score, predicted)`` of every row; one pass, the model is broadcast.

    Whole texts are scored, from nothing but their letters. A null text is an empty one,
    and an empty one is scored like any other. Repeated rows stay repeated.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            found = [shared.value.scores(block) for block in _blocks(texts)]
            scores = np.concatenate(found) if found else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64()),
                 pa.array((scores >= DECIDED).astype(np.int32))],
                ["doc_id", "score", "predicted"],
            )

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("string")
    ).mapInArrow(of_batches, f"doc_id {kind}, score double, predicted int")


def judged(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, lang, logit)`` of every row, kept: what the model says of whole texts."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            names, logits = [], [np.zeros(0)]
            for block in _blocks(texts):
                names += [name for name, _ in shared.value.languages.predict_all(block)]
                logits.append(shared.value.network.logits(block).astype(np.float64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.string()), pa.array(np.concatenate(logits), pa.float64())],
                ["doc_id", "lang", "logit"],
            )

    kind = docs.schema[doc_id].dataType.simpleString()
    return settle(docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("string")
    ).mapInArrow(of_batches, f"doc_id {kind}, lang string, logit double"), "judged")


def thresholds(found: DataFrame, labels: DataFrame, model: Model, doc_id: str = "doc_id",
               label: str = "toxic") -> tuple[dict, float]:
    """Thresholds from all rows of ``found``, of ``judged``, that have a label and trained nothing.

    Texts are counted per language and step of 1/1024 of the logit. So the driver holds
    some thousand counts per language, however many texts there are.
    """
    spark = found.sparkSession
    learned = spark.createDataFrame([(i,) for i in model.learned], found.select("doc_id").schema)
    step = F.round(F.greatest(F.lit(-64.0), F.least(F.lit(64.0), F.col("logit"))) * 1024).cast("long")
    counts = found.join(F.broadcast(learned), "doc_id", "left_anti").join(
        _marked(labels, doc_id, label), "doc_id").groupBy("lang", "toxic", step.alias("step")).agg(
        F.count(F.lit(1)).alias("n")).orderBy("lang", "step", "toxic").collect()
    toxic = np.array([r.toxic for r in counts], bool)
    if not toxic.any() or toxic.all():
        return model.thresholds, model.default
    return _calibrated(np.array([r.step for r in counts]) / 1024, toxic, [r.lang for r in counts],
                       np.array([r.n for r in counts], np.int64))


def score_calibrated(docs: DataFrame, labels: DataFrame, model: Model, doc_id: str = "doc_id",
                     text: str = "text", label: str = "toxic") -> DataFrame:
    """``score``, with thresholds from all ``labels`` of the rows; texts are read once."""
    if model.network is None:
        return score(docs, model, doc_id, text)
    found = judged(docs, model, doc_id, text)
    limits, default = thresholds(found, labels, model, doc_id, label)
    limit = F.lit(default)
    for name, value in limits.items():
        limit = F.when(F.col("lang") == name, F.lit(value)).otherwise(limit)
    away = F.col("logit") - limit + F.lit(float(np.log(DECIDED / (1 - DECIDED))))
    return found.withColumn(
        "score", 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), away))))
    ).select("doc_id", "score", (F.col("score") >= DECIDED).cast("int").alias("predicted"))


def held_out(doc_id: str = "doc_id") -> Column:
    """The third of the ids whose labels are not learned; null ids are not in it."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))
