"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals.

Labels are given for documents, so training tokens are labelled first: a word
(or its first four or five letters) that occurs in toxic documents far more
often than in others is a toxic token there. The chain has two tags; a token's
features are its word and those prefixes. Forward-backward over the whole text
gives each token's marginal; the largest one and their sum give the score of
the document through a logistic function, runs of likely tokens the spans.

The model is fitted on at most ``per_class`` labelled documents of each class;
statistics and scores are computed in tasks.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import id_remainder, plain_names, sample_of_class, stored

WORD = re.compile(r"[^\W\d_]+")
_KNOWN_WORDS = 100_000
_SEGMENT = 64


def features(word: str) -> list[str]:
    """A word and its prefixes, told apart by a mark."""
    word = word.lower()
    return ["w" + word, *(f"{n}{word[:n]}" for n in (4, 5) if len(word) >= n)]


@dataclass
class ChainModel:
    """Weights of the chain and of the document score."""

    weights: dict[str, float] = field(default_factory=dict)
    bias: float = -6.0
    transitions: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    document: tuple[float, float, float] = (-2.0, 1.0, 0.0)

    def emission(self, word: str) -> float:
        return self.bias + sum(self.weights.get(f, 0.0) for f in features(word))

    def score(self, largest: np.ndarray, total: np.ndarray) -> np.ndarray:
        a, b, c = self.document
        return 1 / (1 + np.exp(-np.clip(a + b * _logit(largest) + c * np.log1p(total), -35, 35)))


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


# --- inference --------------------------------------------------------------

def marginals(emissions: np.ndarray, lengths: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """Probability of the toxic tag of every token; texts lie one after the other in ``emissions``.

    Texts are cut into segments. The product of a segment's 2x2 matrices is
    computed for all segments at once, boundary vectors run through the
    segments of a text, then all segments are filled in. This is exact for any
    length, and no step depends on one long text alone.
    """
    total = int(lengths.sum())
    if not total:
        return np.zeros(0)
    lengths = lengths[lengths > 0]
    per_text = -(-lengths // _SEGMENT)
    first_segment = np.cumsum(per_text) - per_text
    text = np.repeat(np.arange(len(lengths)), lengths)
    position = np.arange(total) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    row, column = first_segment[text] + position // _SEGMENT, position % _SEGMENT
    segments = int(per_text.sum())
    starts = np.zeros(segments, dtype=bool)
    starts[first_segment] = True
    # Matrix entries of every step; the places behind a text's end keep what comes in.
    step = np.exp(transitions - transitions.max())
    t00, t11 = np.ones((2, _SEGMENT, segments))
    t01, t10 = np.zeros((2, _SEGMENT, segments))
    odds = np.exp(np.clip(emissions, -30, 30))
    t00[column, row], t01[column, row] = step[0, 0], step[0, 1] * odds
    t10[column, row], t11[column, row] = step[1, 0], step[1, 1] * odds
    t00[0, starts] = t10[0, starts] = 1.0
    t01[0, starts] = t11[0, starts] = odds[(column == 0) & starts[row]]
    p00, p11 = np.ones((2, segments))
    p01, p10 = np.zeros((2, segments))
    for j in range(_SEGMENT):
        p00, p01 = p00 * t00[j] + p01 * t10[j], p00 * t01[j] + p01 * t11[j]
        p10, p11 = p10 * t00[j] + p11 * t10[j], p10 * t01[j] + p11 * t11[j]
        scale = 1 / (p00 + p01 + p10 + p11)
        p00, p01, p10, p11 = p00 * scale, p01 * scale, p10 * scale, p11 * scale
    # Boundary vectors as the share of the toxic tag.
    ahead, behind = np.full(segments, 0.5), np.full(segments, 0.5)
    longest = int(per_text.max())
    for k in range(1, longest):
        now = first_segment[per_text > k] + k
        old = now - 1
        clean = (1 - ahead[old]) * p00[old] + ahead[old] * p10[old]
        bad = (1 - ahead[old]) * p01[old] + ahead[old] * p11[old]
        ahead[now] = bad / (clean + bad)
    for k in range(longest - 1, 0, -1):
        now = first_segment[per_text > k] + k
        clean = p00[now] * (1 - behind[now]) + p01[now] * behind[now]
        bad = p10[now] * (1 - behind[now]) + p11[now] * behind[now]
        behind[now - 1] = bad / (clean + bad)
    forward = np.empty((_SEGMENT, segments))
    for j in range(_SEGMENT):
        clean = (1 - ahead) * t00[j] + ahead * t10[j]
        bad = (1 - ahead) * t01[j] + ahead * t11[j]
        forward[j] = ahead = bad / (clean + bad)
    toxic = np.empty((_SEGMENT, segments))
    for j in range(_SEGMENT - 1, -1, -1):
        bad = forward[j] * behind
        toxic[j] = bad / (bad + (1 - forward[j]) * (1 - behind))
        clean = t00[j] * (1 - behind) + t01[j] * behind
        bad = t10[j] * (1 - behind) + t11[j] * behind
        behind = bad / (clean + bad)
    return toxic[column, row]


# --- training ---------------------------------------------------------------

def train_chain(windows: list[list[str]], tags: list[np.ndarray], rounds: int = 80, decay: float = 1e-5,
                rate: float = 0.15) -> ChainModel:
    """Weights of greatest penalised likelihood, by Adam over all windows (of at most one segment)."""
    names: dict[str, int] = {}
    token, feature = [], []
    place = 0
    for words in windows:
        for word in words:
            for f in features(word):
                token.append(place)
                feature.append(names.setdefault(f, len(names)))
            place += 1
    token_of, feature_of = np.array(token, dtype=np.int64), np.array(feature, dtype=np.int64)
    lengths = np.array([len(w) for w in windows])
    gold = np.concatenate(tags).astype(float)
    inside = np.ones(len(gold), dtype=bool)  # tokens that have a predecessor
    inside[np.cumsum(lengths) - lengths] = False
    after = np.flatnonzero(inside)
    seen = np.zeros((2, 2))
    np.add.at(seen, (gold[after - 1].astype(int), gold[after].astype(int)), 1)
    size = len(names) + 5
    x, mean, square = np.zeros(size), np.zeros(size), np.zeros(size)
    x[-5] = -4.0
    for t in range(1, rounds + 1):
        emissions = np.bincount(token_of, x[:-5][feature_of], minlength=len(gold)) + x[-5]
        trans = x[-4:].reshape(2, 2)
        p = marginals(emissions, lengths, trans)
        pairs = _pair_marginals(emissions, lengths, trans, p, after)
        error = gold - p
        slope = np.empty(size)
        slope[:-5] = np.bincount(feature_of, error[token_of], minlength=len(names))
        slope[-5] = error.sum()
        slope[-4:] = (seen - pairs).ravel()
        slope = slope / len(windows) - decay * x
        mean, square = 0.9 * mean + 0.1 * slope, 0.99 * square + 0.01 * slope ** 2
        x += rate * (mean / (1 - 0.9 ** t)) / (np.sqrt(square / (1 - 0.99 ** t)) + 1e-8)
    weights = {name: float(x[i]) for name, i in names.items() if abs(x[i]) > 0.01}
    return ChainModel(weights, float(x[-5]), x[-4:].reshape(2, 2).copy())


def _pair_marginals(emissions: np.ndarray, lengths: np.ndarray, trans: np.ndarray, p: np.ndarray,
                    after: np.ndarray) -> np.ndarray:
    """Expected number of each transition.

    With P(next | tags before and text) = forward of the chain cut at the pair,
    the pair marginal follows from the marginals of both tokens and the odds
    ratio of the transition, which the text around them does not change.
    """
    ratio = np.exp(np.clip(trans[0, 0] + trans[1, 1] - trans[0, 1] - trans[1, 0], -30, 30))
    a, b = p[after - 1], p[after]
    if abs(ratio - 1) < 1e-9:
        both = a * b
    else:
        s = 1 + (a + b) * (ratio - 1)
        both = (s - np.sqrt(np.maximum(s * s - 4 * ratio * (ratio - 1) * a * b, 0))) / (2 * (ratio - 1))
    both = np.clip(both, np.maximum(0, a + b - 1), np.minimum(a, b))
    return np.array([[(1 - a - b + both).sum(), (b - both).sum()], [(a - both).sum(), both.sum()]])


def fit(docs: DataFrame, labels: DataFrame, per_class: int = 3000, windows: int = 4000, support: float = 0.01,
        odds: float = 25.0, surprise: float = 1.5) -> ChainModel:
    """Model from ``labels(doc_id, toxic)`` and the texts of ``docs``.

    Bounds: ``per_class`` different texts of each label and ``windows`` training
    windows (half with toxic tokens). A feature tells if toxic documents have it
    ``odds`` times as often, at least ``support`` of them do, and the difference
    is more than chance gives among all features (a likelihood ratio of
    ``surprise`` times the logarithm of their number).
    Without any toxic row the model finds every text clean.
    """
    clean_model = ChainModel(document=(-8.0, 0.0, 0.0))
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").select(
        F.col("doc_id").cast("bigint").alias("doc_id"), (F.col("toxic") > 0).alias("toxic"))
    amounts = {r.toxic: r.n for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not amounts.get(True):
        return clean_model
    chosen = sample_of_class(known, "doc_id", F.col("toxic"), per_class)  # at most 2 * per_class ids
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id")
    # Ids may repeat, in the labels and in the documents, so the texts are bounded once more.
    texts = texts.where("text IS NOT NULL").dropDuplicates(["text"]).withColumn("key", F.xxhash64("text"))
    texts = stored(sample_of_class(texts, "key", F.col("toxic"), per_class), "toxic-sample")
    cut = _windows(texts.withColumn("doc_id", F.col("key")))
    sizes = {r.toxic: r.n for r in texts.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, clean = sizes.get(True, 0), sizes.get(False, 0)
    if not toxic:
        return clean_model
    used = cut.groupBy("doc_id", "toxic").agg(F.collect_list("features").alias("features")).select(
        "toxic", F.explode(F.array_distinct(F.flatten("features"))).alias("feature"))
    counted = stored(used.groupBy("feature").agg(
        F.count_if("toxic").alias("toxic_docs"), F.count_if(~F.col("toxic")).alias("clean_docs")), "toxic-features")
    telling = stored(counted.where(
        (F.col("toxic_docs") >= max(3.0, support * toxic))
        & (F.col("toxic_docs") / toxic >= odds * (F.col("clean_docs") + 0.5) / max(clean, 1))
        & (_surprise(F.col("toxic_docs"), F.col("clean_docs"), toxic, clean) >= surprise * np.log(max(counted.count(), 2)))
    ).select("feature"), "toxic-lexicon")
    hits = cut.where("toxic").select("doc_id", "place", F.explode("features").alias("feature")).join(
        telling, "feature", "left_semi").select("doc_id", "place").distinct().withColumn("hit", F.lit(True))
    marked = cut.join(hits, ["doc_id", "place"], "left").withColumn("hit", F.coalesce("hit", F.lit(False)))
    window = stored(sample_of_class(marked.withColumn("key", F.xxhash64("doc_id", "place")), "key", F.col("hit"),
                                    windows // 2).select("words", "toxic", "features"), "toxic-training")
    rows = window.select("words", "toxic").collect()
    # The part of the lexicon that the training windows hold: their words bound it.
    lexicon = {r.feature for r in window.where("toxic").select(F.explode("features").alias("feature")).distinct().join(
        telling, "feature", "left_semi").collect()}
    if not lexicon:
        return clean_model
    rows.sort(key=lambda r: r.words)
    tags = [np.array([r.toxic and not lexicon.isdisjoint(features(w)) for w in r.words]) for r in rows]
    model = train_chain([r.words for r in rows], tags)
    seen = score(texts.select("doc_id", "text", "toxic"), model, ["toxic"]).select("toxic", "largest", "total").collect()
    _fit_document(model, seen, amounts)
    return model


def _surprise(a, b, toxic: int, clean: int):
    """Likelihood ratio (G squared) of a feature in ``a`` of ``toxic`` and ``b`` of ``clean`` documents."""
    share = (a + b) / (toxic + clean)

    def term(seen, expected):
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    return 2 * (term(a, share * toxic) + term(toxic - a, (1 - share) * toxic)
                + term(b, share * clean) + term(clean - b, (1 - share) * clean))


def _windows(texts: DataFrame) -> DataFrame:
    """Windows of at most one segment: doc_id, toxic, place, words, features."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc_id, toxic, text in zip(*(c.to_pylist() for c in batch.columns)):
                words = WORD.findall(text)
                parts = [words[i:i + _SEGMENT] for i in range(0, len(words), _SEGMENT)]
                own = [sorted({f for w in p for f in features(w)}) for p in parts]
                yield pa.RecordBatch.from_arrays([
                    pa.array([doc_id] * len(parts), pa.int64()), pa.array([toxic] * len(parts), pa.bool_()),
                    pa.array(range(len(parts)), pa.int32()), pa.array(parts, pa.list_(pa.string())),
                    pa.array(own, pa.list_(pa.string()))], names=["doc_id", "toxic", "place", "words", "features"])

    return stored(texts.select("doc_id", "toxic", "text").mapInArrow(
        cut, "doc_id bigint, toxic boolean, place int, words array<string>, features array<string>"), "toxic-windows")


def _fit_document(model: ChainModel, seen: list, amounts: dict[bool, int]) -> None:
    """Logistic function of largest and summed marginal, weighted to the classes' share of all labels."""
    y = np.array([r.toxic for r in seen], dtype=float)
    x = np.column_stack([np.ones(len(y)), _logit(np.array([r.largest for r in seen])),
                         np.log1p(np.array([r.total for r in seen]))])
    weight = np.where(y > 0, amounts.get(True, 0) / max(y.sum(), 1), amounts.get(False, 0) / max((1 - y).sum(), 1))
    weight = weight / weight.sum() * len(y)
    beta = np.zeros(3)
    for _ in range(30):  # Newton steps with a small penalty
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (weight * (y - p)) - 0.1 * beta
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(3)
        beta = beta + np.clip(np.linalg.solve(curve, slope), -2, 2)
    model.document = tuple(float(b) for b in beta)


# --- scoring ----------------------------------------------------------------

class _Emissions(dict):
    def __init__(self, model: ChainModel):
        super().__init__()
        self.model = model

    def __missing__(self, word: str) -> float:
        if len(self) >= _KNOWN_WORDS:
            self.clear()
        value = self[word] = self.model.emission(word)
        return value


SPANS = "array<struct<begin:int,stop:int,score:double>>"


def score(docs: DataFrame, model: ChainModel, keep: list[str] = [], tokens_at_once: int = 1 << 16) -> DataFrame:  # noqa: B006
    """doc_id, the columns of ``keep``, score, largest, total and spans of every row.

    ``spans`` are runs of tokens with a marginal of one half or more: offsets
    in characters, and the run's largest marginal. A text without words (null,
    empty) has no spans and the score of an all-clean text.
    """
    kept = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", *keep)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema if f.name != "text")
    out = f"{schema}, score double, largest double, total double, spans {SPANS}"
    span = pa.list_(pa.struct([("begin", pa.int32()), ("stop", pa.int32()), ("score", pa.float64())]))

    def evaluate(texts: list[str], words: list[list[str]], emission: _Emissions) -> tuple[np.ndarray, np.ndarray, list]:
        lengths = np.array([len(w) for w in words])
        flat = np.fromiter((emission[w] for ws in words for w in ws), dtype=float, count=int(lengths.sum()))
        p = marginals(flat, lengths, model.transitions)
        largest, total, spans, at = np.zeros(len(texts)), np.zeros(len(texts)), [], 0
        for i, n in enumerate(lengths):
            own = p[at:at + n]
            at += n
            largest[i], total[i] = (own.max(), own.sum()) if n else (0.0, 0.0)
            spans.append(_spans(texts[i], own) if largest[i] >= 0.5 else [])
        return largest, total, spans

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        emission = _Emissions(model)
        for batch in batches:
            first = 0
            texts, words, tokens = [], [], 0
            for i, value in enumerate(batch.column(1)):
                texts.append(value.as_py() or "")
                words.append(WORD.findall(texts[-1]))
                tokens += len(words[-1])
                if tokens >= tokens_at_once or i == batch.num_rows - 1:
                    largest, total, spans = evaluate(texts, words, emission)
                    part = batch.slice(first, i + 1 - first)
                    others = [c for n, c in enumerate(part.columns) if n != 1]
                    names = [n for n in batch.schema.names if n != "text"]
                    yield pa.RecordBatch.from_arrays(
                        [*others, pa.array(model.score(largest, total)), pa.array(largest), pa.array(total),
                         pa.array(spans, span)], names=[*names, "score", "largest", "total", "spans"])
                    first, texts, words, tokens = i + 1, [], [], 0

    return kept.mapInArrow(run, out)


def _spans(text: str, p: np.ndarray) -> list[dict]:
    found: list[dict] = []
    last = -2
    for i, word in enumerate(WORD.finditer(text)):
        if p[i] >= 0.5:
            if last == i - 1:
                found[-1]["stop"], found[-1]["score"] = word.end(), max(found[-1]["score"], float(p[i]))
            else:
                found.append({"begin": word.start(), "stop": word.end(), "score": float(p[i])})
            last = i
    return found


def training_labels(labels: DataFrame, divisor: int = 5) -> DataFrame:
    """The label rows that may be learned from."""
    return labels.where(id_remainder(F.col("doc_id"), divisor) != 0)


def toxicity(docs: DataFrame, labels: DataFrame, per_class: int = 3000) -> DataFrame:
    """doc_id, held_out, score, predicted and spans of every document, after fitting on the labels not held out.

    Null and empty texts are scored like a text without toxic words. Repeated
    rows are scored each. Extra columns are ignored; an empty table of
    documents gives no rows, without labels every score is low.
    """
    model = fit(docs, training_labels(labels), per_class)
    return score(docs, model).select(
        "doc_id", (id_remainder(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), "spans")


def reject_toxic(docs: DataFrame, labels: DataFrame, per_class: int = 3000, threshold: float = 0.5) -> DataFrame:
    """``docs`` without the documents that score ``threshold`` or more.

    Null and empty texts stay, repeated rows are judged each, all columns are
    kept, whatever their names; an empty table gives no rows, without labels
    every document stays.
    """
    model = fit(docs, training_labels(labels), per_class)
    rows, back, new = plain_names(docs)
    passed = rows.withColumn("doc_id", F.col(new["doc_id"]).cast("bigint")).withColumn("text", F.col(new["text"]))
    return score(passed, model, rows.columns).where(F.col("score") < threshold).select(*back)
