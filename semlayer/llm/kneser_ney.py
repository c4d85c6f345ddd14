"""Toxicity by class-conditional Kneser-Ney models.

Two word models, one of toxic and one of ordinary documents, share their backoff counts, which are
those of both classes together, so an expression that is rare in both hardly changes the comparison:

    P_c(w)     = (n_c(w) - D_c)+ / N_c + L_c * C(w)
    P_c(w | h) = (n_c(h, w) - D_c)+ / n_c(h) + L_c(h) * n(h, w) / n(h) * P_c(w) / C(w)

n_c(w) is a continuation count, the number of words that w follows in class c; n_c(h, w) is the number of
texts of the class with h w, so that neither a repetition nor a copy counts.  C(w) is the share of
both classes' continuation counts, and L the mass that the discounts took.  D_c is as much
larger for the larger class as the class, so equal rates are discounted equally.  Where neither
class keeps a count of h w, both leave it to the backoff, and P_1(w) / P_0(w) remains.

A document's evidence is the length-normalised log-likelihood ratio of the whole text and of its
few most toxic distinct words, as a long text may be ordinary but for those; a logistic curve fitted on training documents turns
these into a probability.  Labels are used for training rows alone, and nothing but the
text is scored.

Counts come from Spark.  Scoring needs the model in every task, so training takes at most about
`most_training` labelled documents and `most_bytes` of text, chosen by a hash of the text, which
bounds the model; smaller sets of labels are used whole.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from . import words as W
from .components import written
from .exchange import given_back, text_slices

#: The discount of a count of the smaller class; that of the other is as much larger as the class.
DISCOUNT = 4.0
#: Numbers of most toxic words whose mean is compared.
STRONGEST = (1, 2, 4)
#: Sums of each word: the contexts it occurs in, and the counts and discounted counts of what follows it.
SUMS = ("n1", "n0", "s1", "s0", "h1", "h0")
#: Bounds of the training sample, which bound the model: documents, and bytes of their texts.
MOST_TRAINING = 12_000
MOST_BYTES = 48_000_000
EVIDENCE = "evidence_1 double, evidence_2 double, evidence_4 double, evidence_all double"
RESULT = f"doc_id bigint, score double, predicted int, {EVIDENCE}"


class Model(NamedTuple):
    """Log ratios ready to add, of pairs with counts of their own and of other words by themselves."""

    words: np.ndarray
    single: np.ndarray
    pairs: np.ndarray
    pair: np.ndarray
    unknown: float
    curve: tuple[float, ...]


def tokens_of(texts: W.Texts) -> W.Words:
    """Lower-case runs of letters and digits; every byte above ASCII counts as a letter."""
    return W.words_of(texts, W.NOT_ALNUM_TABLE)


def pair_codes(found: W.Words) -> tuple[np.ndarray, np.ndarray]:
    """Codes of each word with its predecessor, and the predecessors; 0 precedes a text."""
    code = found.code
    before = np.concatenate((np.zeros(1, np.uint64), code[:-1])) if len(code) else code
    before[found.first[:-1][found.first[:-1] < len(code)]] = 0
    return W.mixed(code + W.mixed(before + np.uint64(1))), before


def gram_counts(labelled: DataFrame) -> DataFrame:
    """(a, b, n1, n0) for rows (text, toxic): in how many texts word b follows a.

    Each task sums its own batches before the shuffle.
    """

    def run(batches):
        for batch in (part for whole in batches for part in text_slices(whole)):
            toxic = np.array(batch["toxic"].to_pylist(), np.int64)
            found = tokens_of(W.texts_of(batch["text"], lower=True))
            text = np.repeat(np.arange(len(toxic)), np.diff(found.first))
            label = toxic[text]
            codes, before = pair_codes(found)
            _, once = np.unique(W.mixed(codes) + text.astype(np.uint64), return_index=True)
            _, at, n = np.unique(codes[once] + label[once].astype(np.uint64), return_index=True, return_counts=True)
            at = once[at]
            yield pa.record_batch(
                {
                    "a": pa.array(W.long_id(before[at])),
                    "b": pa.array(W.long_id(found.code[at])),
                    "n1": pa.array(np.where(label[at] == 1, n, 0)),
                    "n0": pa.array(np.where(label[at] == 1, 0, n)),
                }
            )

    each = labelled.select("text", "toxic").mapInArrow(given_back(run), "a bigint, b bigint, n1 bigint, n0 bigint")
    return each.groupBy("a", "b").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))


def discounted(n, discount: float):
    """What is left of a count, as a Column."""
    return F.greatest(n - F.lit(discount), F.lit(0.0))


def tied(size) -> tuple[float, float]:
    """Discounts of toxic and ordinary counts, given the sums of both."""
    toxic, ordinary = size[0] or 0, size[1] or 0
    least = max(min(toxic, ordinary), 1)
    return DISCOUNT * max(toxic / least, 1), DISCOUNT * max(ordinary / least, 1)


def fitted(counts: DataFrame) -> Model:
    """The log ratios of all words and pairs that either class has of its own, from all counts.
    """
    pairs = written(counts, "kneser-ney")
    joint = [discounted(F.col(c), d) for c, d in zip(("n1", "n0"), tied(pairs.agg(F.sum("n1"), F.sum("n0")).first()))]
    zero = F.lit(0.0)
    each = pairs.select("b", *((F.col(c) > 0).cast("double") for c in ("n1", "n0")), *[zero] * 4)
    each = each.union(pairs.select("a", zero, zero, "n1", "n0", *joint)).toDF("b", *SUMS)
    words = written(each.groupBy("b").agg(*(F.sum(c).alias(c) for c in SUMS)), "kneser-ney-words")
    size = words.agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0")).first()
    own = [discounted(F.col(c), d) for c, d in zip(("n1", "n0"), tied(size))]
    words = words.withColumns({"k1": own[0], "k0": own[1]})
    total = words.agg(F.sum("k1").alias("k1"), F.sum("k0").alias("k0")).first()
    often = words.where("n1 + n0 > 1 or h1 + h0 > 0").toPandas().sort_values("b", key=lambda b: b.to_numpy().view(np.uint64))
    pair = pairs.where(joint[0] + joint[1] > 0).withColumns({"k1": joint[0], "k0": joint[1]}).toPandas()
    code = often["b"].to_numpy().astype(np.int64).view(np.uint64)
    a, b = (pair[c].to_numpy().astype(np.int64).view(np.uint64) for c in "ab")
    word_of, context_of = np.searchsorted(code, b), np.searchsorted(code, a)
    shared = (often["n1"] + often["n0"] + 1.0).to_numpy() / ((size["n1"] or 0) + (size["n0"] or 0) + 1.0)
    left, low, high = {}, {}, {}
    for c in "10":
        n = max(size[f"n{c}"] or 0, 1)
        left[c] = 1.0 - (total[f"k{c}"] or 0) / n
        low[c] = often[f"k{c}"].to_numpy() / n + left[c] * shared
        after = np.maximum(often[f"s{c}"].to_numpy(), 1)[context_of]
        rest = 1.0 - often[f"h{c}"].to_numpy()[context_of] / after
        both = (pair["n1"] + pair["n0"]).to_numpy() / (often["s1"] + often["s0"]).to_numpy()[context_of]
        high[c] = pair[f"k{c}"].to_numpy() / after + rest * both * (low[c] / shared)[word_of]
    codes = W.mixed(b + W.mixed(a + np.uint64(1)))
    order = np.argsort(codes)
    return Model(
        code,
        np.log(low["1"] / low["0"]),
        codes[order],
        np.log(high["1"] / high["0"])[order],
        float(np.log(left["1"] / left["0"])),
        (0.0, 1.0, 0.0, 0.0, 0.0),
    )


def looked_up(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each wanted code lies among sorted keys, and whether it is there."""
    if len(keys) == 0:
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), dtype=bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def ratios(model: Model, found: W.Words) -> np.ndarray:
    """log P_toxic - log P_ordinary of each word in its place."""
    if len(found.code) == 0:
        return np.zeros(0)
    distinct, back = np.unique(found.code, return_inverse=True)
    at, known = looked_up(model.words, distinct)
    value = np.where(known, model.single[at] if len(model.single) else 0.0, model.unknown)[back]
    codes, _ = pair_codes(found)
    at, known = looked_up(model.pairs, codes)
    value[known] = model.pair[at[known]]
    return value


def evidence(model: Model, texts: W.Texts) -> np.ndarray:
    """Of each text: the mean log ratio of its 1, 2 and 4 most toxic distinct words, and of all words."""
    found = tokens_of(texts)
    value = ratios(model, found)
    out = np.zeros((len(found.first) - 1, len(STRONGEST) + 1))
    text = np.repeat(np.arange(len(out)), np.diff(found.first))
    order = np.lexsort((-value, found.code, text))
    once = np.ones(len(order), dtype=bool)
    once[1:] = (np.diff(text[order]) != 0) | (np.diff(found.code[order]) != 0)
    most = value[order[once]]
    edge = np.searchsorted(text[order[once]], np.arange(len(out) + 1))
    for i, (low, high) in enumerate(zip(found.first[:-1], found.first[1:])):
        if high > low:
            out[i, -1] = value[low:high].mean()
            best = -np.sort(-most[edge[i] : edge[i + 1]])[: max(STRONGEST)]
            for k, n in enumerate(STRONGEST):
                out[i, k] = best[:n].sum() / n
    return out


def evidence_columns(seen: np.ndarray) -> dict[str, pa.Array]:
    names = ("evidence_1", "evidence_2", "evidence_4", "evidence_all")
    return {name: pa.array(np.ascontiguousarray(seen[:, k])) for k, name in enumerate(names)}


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, rounds: int = 50) -> np.ndarray:
    """Weights of a logistic regression by Newton's method."""
    weight = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ weight, -30, 30)))
        slope = x.T @ (y - p) - ridge * weight
        curve = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(x.shape[1])
        step = np.linalg.solve(curve, slope)
        weight += step
        if np.abs(step).max() < 1e-8:
            break
    return weight


def probability(model: Model, seen: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(model.curve[0] + seen @ np.array(model.curve[1:]), -30, 30)))


def training_share(size: Row, most_training: int = MOST_TRAINING, most_bytes: int = MOST_BYTES) -> float:
    """Which share of so many (n) distinct texts of so many bytes training takes."""
    return min(1.0, most_training / max(size["n"], 1), most_bytes / max(size["bytes"] or 0, 1))


def train(labelled: DataFrame, most_training: int = MOST_TRAINING, most_bytes: int = MOST_BYTES) -> Model:
    """A model of rows (text, toxic 0 or 1; other labels are left out).  Equal texts count once.

    Without any toxic label every score is below 0.5.  Three of four sampled rows give the counts, the fourth the curve, so that the curve is fitted
    on documents whose words the model has not seen.
    """
    rows = labelled.where("toxic in (0, 1)").select(
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.col("toxic").cast("int").alias("toxic")
    )
    rows = rows.groupBy("text").agg(F.max("toxic").alias("toxic")).withColumn("dealt", F.pmod(F.xxhash64("text"), F.lit(1 << 32)))
    size = rows.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes")).first()
    share = training_share(size, most_training, most_bytes)
    rows = rows.where(F.col("dealt") < int(share * (1 << 32)))
    model = fitted(gram_counts(rows.where("dealt % 4 <> 0")))
    shared = labelled.sparkSession.sparkContext.broadcast(tuple(model))

    def judge(batches):
        for batch in (part for whole in batches for part in text_slices(whole)):
            seen = evidence(Model(*shared.value), W.texts_of(batch["text"], lower=True))
            yield pa.record_batch({**evidence_columns(seen), "toxic": batch["toxic"]})

    seen = rows.where("dealt % 4 = 0").select("text", "toxic").mapInArrow(given_back(judge), f"{EVIDENCE}, toxic int").toPandas()
    if seen["toxic"].nunique() < 2:
        # Too few labels for a curve: the share of toxic ones, or the plain evidence where both occur.
        n = rows.agg(F.count_if(F.col("toxic") == 1).alias("toxic"), F.count_if(F.col("toxic") == 0).alias("ordinary")).first()
        slope = 1.0 if n["toxic"] and n["ordinary"] else 0.0
        return model._replace(curve=(float(np.log((n["toxic"] + 0.5) / (n["ordinary"] + 1.0))), 0.0, 0.0, 0.0, slope))
    x = np.column_stack((np.ones(len(seen)), seen[[*evidence_columns(np.zeros((0, 4)))]]))
    return model._replace(curve=tuple(logistic(x, seen["toxic"].to_numpy().astype(float))))


def score_toxicity(documents: DataFrame, model: Model) -> DataFrame:
    """doc_id, score (0 to 1), predicted (score >= 0.5) and the evidence of each row.

    A null or empty text has no evidence and gets the curve's value at 0.
    """
    shared = documents.sparkSession.sparkContext.broadcast(tuple(model))

    def run(batches):
        for batch in (part for whole in batches for part in text_slices(whole)):
            trained = Model(*shared.value)
            seen = evidence(trained, W.texts_of(batch["text"], lower=True))
            p = probability(trained, seen)
            yield pa.record_batch(
                {
                    "doc_id": batch["doc_id"],
                    "score": pa.array(p),
                    "predicted": pa.array((p >= 0.5).astype(np.int32)),
                    **evidence_columns(seen),
                }
            )

    docs = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(given_back(run), RESULT)


