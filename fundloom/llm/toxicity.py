"""Abusive, hateful and sexual content: a bag of subwords, averaged, into a linear softmax, trained in numpy.

A document is scored by its worst passage, since one sentence among forty is enough. Passages are sentences; their
letter n-grams are hashed to rows of an embedding table, which is trained jointly with the softmax, so an unseen
misspelling shares most of its vectors with what it stands for. Ratings are of whole documents and err, so training
repeats: passages of flagged documents start as positive, the next round keeps those the model of the last one believes.

The fit reads at most TRAIN_DOCS rated documents drawn by hash; its folds run as tasks of their own, beside each other.
``learn`` gives a ``Model`` that several scorings can share. Scoring is one pass over the corpus without a shuffle; what
is broadcast is one number per bucket.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TRAIN_DOCS = 10_000
#: Characters of a rated document's passages that training reads at most; documents are drawn until this is reached.
TRAIN_CHARS = 5_000_000
BUCKETS = 1 << 16
DIM = 16
SIZES = (3, 4, 5, 6)
LONGEST = 400
SHORT = 28
#: What the threshold is drawn towards, and how many flagged documents that counts as: one rule for any number of ratings.
PRIOR_MARK, PRIOR_DOCS = 0.25, 20
#: N-grams of no content that every passage has besides its own, so that a few words alone don't decide.
EMPTY = 30

# Digits and signs that stand for letters inside a word.
_LEET = str.maketrans("013457@$!", "oieastasi")
# Phrases that state the task where ratings are few. Written for this purpose; a rating outweighs them.
SEEDS = (
    "you are an idiot", "you stupid moron", "what a bunch of morons", "shut the fuck up", "you worthless piece of shit", "go and die", "i will kill you", "i know where you live and i will hurt you",
    "nobody would miss you if you died", "kill yourself", "they are vermin and should be driven out", "those people are subhuman", "lock them all up and throw them out of the country", "women are too stupid for science",
    "fucking bastards", "you filthy whore", "send me nudes you slut", "my dick is hard for you", "he fucked her all night", "she moaned while he licked her", "hot girls do anything live on cam", "suck my cock",
    "du bist ein idiot", "halt die fresse du arschloch", "dieses pack gehort vertrieben", "ich will dich ficken", "solche schweine sollte man einsperren", "verrecke endlich",
    "tu es un connard", "ferme ta gueule imbecile", "ces gens sont des rats", "je veux te baiser", "va crever", "sale pute",
    "eres un imbecil", "callate idiota de mierda", "esa gente es basura", "quiero follarte", "ojala te mueras", "hijo de puta",
)
SOBER = (
    "participants rated swear words by how rude they sound", "a classifier for hate speech is trained on posts flagged by moderators", "survivors of domestic abuse helped to design the study", "sexual reproduction in plants is delayed",
    "killing of bacteria was measured", "sexual health services were compared", "the method is weak and the conclusions are not supported by the data", "this proposal is poorly written and adds nothing new", "the process is killed and restarted",
    "sexual harassment policies of universities", "the survey asked about insults and threats at work", "the history of racism in science is documented", "the word idiot was used in old medical texts",
)


# Marks that are written on letters of scripts which are read without them; other scripts' signs are letters of their own.
_MARKS = regex.compile(r"[\u0300-\u036f\u0591-\u05c7\u064b-\u065f\u0670\p{Cf}]+")
_LEET_WORD = re.compile(r"[a-z0-9@$!]*[a-z][013457@$!]+[a-z][a-z0-9@$!]*")
_SPACED = re.compile(r"(?<![a-z])(?:[a-z][ .\-_]){2,}[a-z](?![a-z])")
_STRETCHED = re.compile(r"([a-z])\1{2,}")
_OTHER, _OTHER_ASCII = regex.compile(r"[^\p{L}\p{M}*\n]+"), re.compile(r"[^a-z*\n]+")
_ENDS = re.compile(r"(?<=[.!?。！？।؟])\s+|[\n\r\u2028\u2029]+")


def clean(text: str) -> str:
    """Text as the model sees it, a line per sentence: no accents or invisible marks, lower case, leet letters and spaced
    or stretched words undone, letters of every script kept."""
    text = text.lower()
    plain = text.isascii()
    if not plain:
        text = unicodedata.normalize("NFC", _MARKS.sub("", unicodedata.normalize("NFKD", text).replace("ß", "ss")))
    text = _LEET_WORD.sub(lambda m: m[0].translate(_LEET), text)
    text = _SPACED.sub(lambda m: re.sub(r"[ .\-_]", "", m[0]), text)
    text = _ENDS.sub("\n", _STRETCHED.sub(r"\1\1", text))
    return (_OTHER_ASCII if plain else _OTHER).sub(" ", text)


def passages(text: str | None) -> list[str]:
    """Cleaned sentences of a text, long ones in pieces that overlap by a quarter; none for empty and null text. A sentence
    of a few words only goes with the one before it, the first one with the next."""
    out: list[str] = []
    for s in clean(text or "").split("\n"):
        s = s.strip()
        if out and (len(s) < SHORT or len(out) == 1 and len(out[0]) < SHORT) and len(out[-1]) + len(s) < LONGEST:
            out[-1] = f"{out[-1]} {s}".strip()
            continue
        step = LONGEST * 3 // 4
        out += [s] if len(s) <= LONGEST else [s[i : i + LONGEST] for i in range(0, len(s) - LONGEST + step, step)]
    return [s for s in out if s]


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every letter n-gram of many passages, and the passage each belongs to (in order of passage)."""
    if not texts:
        return np.empty(0, np.int32), np.empty(0, np.int64)
    code = np.frombuffer("\n".join(f" {t} " for t in texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    gap = code == 10
    owner = np.cumsum(gap)
    buckets, owners = [], []
    for size in SIZES:
        n = len(code) - size + 1
        if n <= 0:
            continue
        h = np.full(n, size, np.uint64)
        for j in range(size):
            h = h * np.uint64(0x100000001B3) + code[j : n + j]
        h ^= h >> np.uint64(31)
        h *= np.uint64(0x9E3779B97F4A7C15)
        whole = (owner[size - 1 :] == owner[:n]) & ~gap[:n]
        buckets.append((h >> np.uint64(40))[whole].astype(np.int64) % BUCKETS)
        owners.append(owner[:n][whole])
    b, o = np.concatenate(buckets), np.concatenate(owners)
    order = np.argsort(o, kind="stable")
    return b[order].astype(np.int32), o[order]


def probabilities(texts: list[str], logit: np.ndarray) -> np.ndarray:
    """Probability of each passage, given each bucket's share of the logit (offset last)."""
    b, o = grams(texts)
    n = EMPTY + np.bincount(o, minlength=len(texts))
    z = np.bincount(o, weights=logit[:-1][b], minlength=len(texts)) / n + logit[-1]
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def packed(texts: list[str], chunk: int = 2000) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all passages one after another, and where each passage's begin; made in chunks to stay small."""
    parts, sizes = [np.empty(0, np.int32)], [np.zeros(1, np.int64)]
    for at in range(0, len(texts), chunk):
        b, o = grams(texts[at : at + chunk])
        parts.append(b)
        sizes.append(np.bincount(o, minlength=len(texts[at : at + chunk])))
    return np.concatenate(parts), np.cumsum(np.concatenate(sizes))


def train(b: np.ndarray, start: np.ndarray, rows_in: np.ndarray, y: np.ndarray, weight: np.ndarray, passes: int = 100_000, rate: float = 0.8, batch: int = 256, seed: int = 7) -> np.ndarray:
    """Logit per bucket (offset last) of the model fitted to passages ``rows_in`` of packed buckets.

    Two softmax outputs differ by one direction in the embedding, so table and softmax are trained as such, with steps
    scaled by past gradients, and multiplied out in the end. Five epochs, more where there are few passages.
    """
    epochs = min(40, max(5, -(-passes // max(1, len(rows_in)))))
    rng = np.random.default_rng(seed)
    table = rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32)
    soft = rng.normal(0, 0.1, DIM).astype(np.float32)
    bias = np.float32(0)
    seen, seen_soft = np.full(BUCKETS, 0.1, np.float32), np.full(DIM, 0.1, np.float32)
    for epoch in range(epochs):
        lr = rate * (1 - 0.8 * epoch / epochs)
        order = rng.permutation(len(rows_in))
        for at in range(0, len(order), batch):
            mine = order[at : at + batch]
            rows = rows_in[mine]
            size = start[rows + 1] - start[rows]
            mine, rows, size = mine[size > 0], rows[size > 0], size[size > 0]
            if not len(rows):
                continue
            pick = np.repeat(start[rows] - np.cumsum(size) + size, size) + np.arange(size.sum())
            idx = b[pick]
            mean = np.add.reduceat(table[idx], np.cumsum(size) - size, axis=0) / (EMPTY + size[:, None])
            p = 1 / (1 + np.exp(-np.clip(mean @ soft + bias, -30, 30)))
            g = ((p - y[mine]) * weight[mine]).astype(np.float32)
            per = np.repeat(g / (EMPTY + size), size)
            mass = np.bincount(idx, weights=per, minlength=BUCKETS).astype(np.float32)
            at_b = np.flatnonzero(mass)
            grad = mass[at_b, None] * soft
            seen[at_b] += (grad**2).mean(1) * 100
            gs = mean.T @ g
            seen_soft += gs**2
            table[at_b] -= lr * grad * 10 / np.sqrt(seen[at_b, None])
            soft -= lr * 0.1 * gs / np.sqrt(seen_soft)
            bias -= np.float32(lr * 0.02 * g.sum())
    return np.append(table @ soft, bias).astype(np.float64)


class Model(NamedTuple):
    """Logit per bucket (offset last), and the least score of a flagged document."""

    logit: np.ndarray
    mark: float


class _Here(NamedTuple):
    value: tuple[np.ndarray, np.ndarray]


def _scored(b: np.ndarray, start: np.ndarray, logit: np.ndarray, rows: np.ndarray) -> np.ndarray:
    out = np.zeros(len(rows))
    for at in range(0, len(rows), 2000):
        part = rows[at : at + 2000]
        size = start[part + 1] - start[part]
        pick = np.repeat(start[part] - np.cumsum(size) + size, size) + np.arange(size.sum())
        z = np.bincount(np.repeat(np.arange(len(part)), size), weights=logit[:-1][b[pick]], minlength=len(part)) / (EMPTY + size) + logit[-1]
        out[at : at + 2000] = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    return out


def _tasks(spark: SparkSession | None, work, n: int) -> list[np.ndarray]:
    """``work(0)`` to ``work(n - 1)``, each in a task of its own; in this process without a session."""
    if spark is None:
        return [work(k) for k in range(n)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for k in batch["id"]:
                yield pd.DataFrame({"k": [k], "x": [work(k).astype(np.float32).tobytes()]})

    got = {r.k: np.frombuffer(r.x, np.float32).astype(np.float64) for r in spark.range(0, n, 1, n).mapInPandas(run, "k long, x binary").collect()}
    return [got[k] for k in range(n)]


def fit(docs: list[list[str]], rating: np.ndarray, folds: int = 3, spark: SparkSession | None = None) -> Model:
    """The model of documents given as passages, with their mean rating. Split ratings take no part.

    Which passages of a flagged document are to blame is decided by models that haven't seen that document: what also
    stands in documents nobody flagged gets a low score from them, and so do all passages of one flagged by mistake.
    The mark has the best F1 over documents scored by a model of the other folds, drawn towards PRIOR_MARK as if
    PRIOR_DOCS flagged documents had asked for that; with no ratings it is PRIOR_MARK.
    """
    hot, sober = [clean(t).strip() for t in SEEDS], [clean(t).strip() for t in SOBER]
    texts, owner = [p for d in docs for p in d], np.repeat(np.arange(len(docs)), [len(d) for d in docs])
    held = packed([*texts, *hot, *sober])
    held = spark.sparkContext.broadcast(held) if spark else _Here(held)
    seeds = np.arange(len(texts), len(texts) + len(hot) + len(sober))
    seed_y = np.r_[np.ones(len(hot)), np.zeros(len(sober))]
    flagged = rating[owner] > 0.5
    use = np.abs(rating[owner] - 0.5) > 0.2
    fold = np.arange(len(docs))[owner] % folds

    def learned(rows: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Positives weigh up to a tenth of all."""
        b, start = held.value
        y = np.r_[y, seed_y]
        weight = np.where(y > 0, min(10.0, max(1.0, 0.1 / max(y.mean(), 1e-3))), 1.0)
        return train(b, start, np.r_[rows, seeds], y, weight)

    def crossed(y: np.ndarray, keep: np.ndarray, whole: bool) -> tuple[np.ndarray, np.ndarray | None]:
        """Scores of all passages, each by a model of the other folds; with ``whole`` also the model of all that is kept."""

        def work(k: int) -> np.ndarray:
            inside = np.flatnonzero(keep & (fold != k))
            logit = learned(inside, y[inside])
            return logit if k == folds else _scored(*held.value, logit, np.flatnonzero(fold == k))

        parts = _tasks(spark, work, folds + whole)
        p = np.zeros(len(texts))
        for k in range(folds):
            p[fold == k] = parts[k]
        return p, parts[folds] if whole else None

    p, _ = crossed(flagged.astype(float), use, False)
    calm = p[use & ~flagged]
    mark = max(0.2, float(np.quantile(calm, 0.995))) if len(calm) else 0.5
    y = (flagged & (p >= mark)).astype(float)
    # Passages of calm documents that look worse than nearly all others are as likely overlooked as calm.
    p, logit = crossed(y, use & ((y > 0) | (~flagged & (p < max(0.8, mark)))), True)
    top = np.zeros(len(docs))
    np.maximum.at(top, owner, p)
    sure = np.abs(rating - 0.5) > 0.2
    s, t = top[sure], rating[sure] > 0.5
    marks = np.arange(0.1, 0.97, 0.02)
    f1 = np.array([2 * (t & (s >= m)).sum() / max(1, t.sum() + (s >= m).sum()) for m in marks])
    best = float(np.median(marks[f1 >= f1.max() - 0.005]))
    return Model(logit, float((t.sum() * best + PRIOR_DOCS * PRIOR_MARK) / (t.sum() + PRIOR_DOCS)))


def learn(documents: DataFrame, ratings: DataFrame) -> Model:
    """The model of rated documents; ratings of missing documents and null ratings count for nothing."""
    mean = ratings.where("doc_id is not null and flagged is not null").groupBy("doc_id").agg(F.avg(F.col("flagged").cast("double")).alias("rating"))
    drawn = documents.select("doc_id", "text").join(mean, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAIN_DOCS)
    docs, rating, chars = [], [], 0
    for r in drawn.toLocalIterator():
        docs.append(passages(r.text))
        rating.append(r.rating)
        chars += sum(map(len, docs[-1]))
        if chars > TRAIN_CHARS:
            break
    return fit(docs, np.array(rating), spark=documents.sparkSession)


def scores(documents: DataFrame, ratings: DataFrame, model: Model | None = None) -> DataFrame:
    """``(doc_id, source, score, flagged)``: the probability of a document's worst passage, and whether it reaches the
    model's mark. Null, empty and blank texts score 0. Rows are kept as they come, null doc_id and repeated rows included.
    Without a ``model`` one is learnt from the ratings."""
    logit, least = model or learn(documents, ratings)
    spark: SparkSession = documents.sparkSession
    model = spark.sparkContext.broadcast(logit.astype(np.float32))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        logit = model.value.astype(np.float64)
        for b in batches:
            out = np.zeros(len(b))
            for at in range(0, len(b), 256):
                docs = [passages(t) for t in b["text"].iloc[at : at + 256]]
                texts = [p for d in docs for p in d]
                if texts:
                    owner = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
                    part = np.zeros(len(docs))
                    np.maximum.at(part, owner, probabilities(texts, logit))
                    out[at : at + len(docs)] = part
            yield pd.DataFrame({"doc_id": b["doc_id"].astype("Int64"), "source": b["source"], "score": out})

    scored = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "source", "text").mapInPandas(run, "doc_id long, source string, score double")
    return scored.withColumn("flagged", F.col("score") >= least)


def rates(scored: DataFrame) -> DataFrame:
    """``(source, documents, flagged, rate, mean_score)`` per source, null being a source of its own."""
    return scored.groupBy("source").agg(F.count("*").alias("documents"), F.sum(F.col("flagged").cast("long")).alias("flagged"), F.avg(F.col("flagged").cast("double")).alias("rate"), F.avg("score").alias("mean_score"))
