"""Toxicity by weak supervision: voters, a generative label model, a linear classifier.

1. Terms (words, and their first four and five letters) that labelled toxic texts have much more
   often are counted over all labelled rows.
2. Sixteen voters look at every text: lexicons (terms, dealt by kind and hash; known insults) and
   patterns of writing. Votes are bits, so the votes of all texts are a histogram of at most 2^16 rows.
3. The label model learns from that histogram how often each voter speaks up in either class, and how
   voters of a class go together, by expectation maximisation; labelled rows keep their class.
   Correlated voters share their weight.
4. A logistic regression on terms is fitted to the posterior labels of all texts, equal ones counted, and scores all.

TERMS bounds the inputs of the regression; rows are not sampled.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from placeweave.llm.common import importable, text_rows, worker_store, written

#: Up to so many labels are sent to all tasks; more of them are joined by a shuffle.
LABELLED_ROWS, TERMS = 12_000, 2_000
#: The regression's penalty on squared weights, and the most steps it takes.
PENALTY, STEPS = 2e-4, 100
#: A term is in at least so many labelled toxic texts and this share of them, at these log odds.
LEAST_TEXTS, LEAST_SHARE, LEAST_ODDS = 3, 0.01, 3.5
WORD = re.compile(r"[^\W\d_]+")
VOTERS, LEXICONS = 16, 10
#: Characters of a text that are cut into words at once.
SLICE_CHARS = 1 << 20

# Insults of four languages.
INSULTS = frozenset("""
    idiot idiots moron morons stupid scum trash garbage loser losers pathetic disgusting worthless clown dumb
    imbecile vermin filth bastard idiotisch dumm dumme dummkopf trottel abschaum widerlich versager schwachkopf
    estúpido estúpida imbécil basura escoria asqueroso inútil payaso perdedor crétin débile ordure racaille
    dégoûtant minable stupide
""".split())


def learnable(key: str = "doc_id", folds: int = 5) -> Column:
    """Whether a row's label may be learned: the CRC-32 of its key as text isn't a multiple of ``folds``."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % folds != 0


def words_of(text: str) -> Counter:
    """How often each word occurs, lower-cased; long texts are read in slices that end between words."""
    found: Counter = Counter()
    at = 0
    while at < len(text):
        end = at + SLICE_CHARS
        while end < len(text) and text[end].isalpha():
            end += 1
        found.update(WORD.findall(text[at:end].lower()))
        at = end
    return found


def terms_of(words: Iterable[str]) -> set[str]:
    """Words, and the beginnings of longer ones, marked by a final hyphen."""
    return {t for w in words for t in ((w,) if len(w) < 5 else (w, w[:4] + "-", w[:5] + "-"))}


def patterns(text: str, words: Counter) -> list[bool]:
    n, letters = max(1, words.total()), max(1, len(text))
    insults = sum(words[w] for w in INSULTS & words.keys())
    return [insults > 0, insults > 1 and insults * 200 > n, text.count("!") * 100 > n, sum(map(str.isupper, text)) * 4 > letters, len(words) * 3 < n and n > 20, n < 20]


def _sample(rows: DataFrame, n: int, key: str) -> DataFrame:
    """At most n rows, chosen by a hash of their key: of larger tables, those under a threshold are sorted, and of ties any are taken.

    For a look at a table; nothing is learned from it.
    """
    total = rows.count()
    lot = F.pmod(F.xxhash64(key), F.lit(1 << 30))
    some = rows.where(lot < int((1 << 30) * min(1.0, 1.2 * n / total))) if total > n else rows
    return some.orderBy(lot, key).limit(n)


def find_terms(labelled: DataFrame) -> list[str]:
    """Up to TERMS terms of texts labelled toxic, most telling first. labelled: text, toxic."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, list[int]] = {}

        def flush():
            out = pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array([x[0] for x in seen.values()], pa.int64()), pa.array([x[1] for x in seen.values()], pa.int64())], names=["term", "toxic", "clean"])
            seen.clear()
            return out

        for batch in batches:
            for text, toxic in zip(batch.column(0), batch.column(1).to_pylist()):
                for t in terms_of(words_of(text.as_py())):
                    seen.setdefault(t, [0, 0])[1 - toxic] += 1
                if len(seen) > 200_000:
                    yield flush()
        yield flush()

    size = labelled.agg(F.sum("toxic").alias("toxic"), F.count("*").alias("n")).first()
    toxic, clean = size.toxic or 0, size.n - (size.toxic or 0)
    if not toxic or not clean:
        return []
    counts = labelled.select("text", "toxic").mapInArrow(count, "term string, toxic long, clean long").groupBy("term").agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c"))
    odds = F.log((F.col("t") + 0.5) / (toxic - F.col("t") + 0.5)) - F.log((F.col("c") + 0.5) / (clean - F.col("c") + 0.5))
    kept = counts.withColumn("odds", odds).where((F.col("t") >= max(LEAST_TEXTS, LEAST_SHARE * toxic)) & (F.col("odds") >= LEAST_ODDS))
    return [r.term for r in kept.orderBy(F.desc(F.col("odds") * F.sqrt("t")), "term").limit(TERMS).collect()]


def voter_of(term: str) -> int:
    kind = 0 if not term.endswith("-") else 1 if len(term) == 5 else 2
    return (0, 4, 7)[kind] + xxhash.xxh32_intdigest(term) % (4, 3, 3)[kind]


def look(text: str, known: dict[str, tuple[int, int]]) -> tuple[int, list[int]]:
    """The votes on a text, a bit for each voter, and the places of its terms. known: place and voter's bit by term."""
    words = words_of(text)
    hits = [known[t] for t in terms_of(words) & known.keys()]
    mask = 0
    for _, bit in hits:
        mask |= bit
    for k, on in enumerate(patterns(text, words)):
        mask |= on << (LEXICONS + k)
    return mask, sorted(k for k, _ in hits)


def known_terms(terms: list[str]) -> dict[str, tuple[int, int]]:
    return {t: (k, 1 << voter_of(t)) for k, t in enumerate(terms)}


def votes(rows: DataFrame, terms: list[str], key: str, text: str) -> DataFrame:
    """(key, mask, found): the votes on each text, and the places of its terms in ``terms``."""
    share = rows.sparkSession.sparkContext.broadcast(known_terms(terms))

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_store("toxicity")
        for batch in batches:
            seen = [look(x.as_py(), share.value) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([m for m, _ in seen], pa.int32()), pa.array([f for _, f in seen], pa.list_(pa.int32()))], names=[key, "mask", "found"])

    return rows.select(key, text).mapInArrow(work, f"{key} long, mask int, found array<int>")


def scored_rows(docs: DataFrame, terms: list[str], weights: np.ndarray, text: str, carry: list[str]) -> DataFrame:
    """(score, carried): whole rows with their scores in one pass, so that nothing but the model is written between."""
    share = docs.sparkSession.sparkContext.broadcast((known_terms(terms), weights))

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_store("toxicity")
        known, w = share.value
        for batch in batches:
            z = [w[-1] + w[look(x.as_py() or "", known)[1]].sum() for x in batch.column(0).field(text)]
            yield pa.RecordBatch.from_arrays([pa.array(1 / (1 + np.exp(-np.clip(np.array(z, float), -500, 500)))), batch.column(0)], names=["score", "carried"])

    rows = docs.select(F.struct(*carry).alias("carried"))
    return rows.mapInArrow(work, StructType([*StructType.fromDDL("score double"), rows.schema["carried"]]))


def label_model(masks: np.ndarray, counts: np.ndarray, known: np.ndarray, rounds: int = 50) -> np.ndarray:
    """P(toxic) of each mask. counts: texts with it; known: labelled (clean, toxic) texts with it."""
    bits = (masks[:, None] >> np.arange(VOTERS) & 1).astype(float)
    speaks = np.full((2, VOTERS), 0.05)
    speaks[1, : LEXICONS + 2] = 0.5  # where to start without labels
    prior = 0.1
    if known.sum() and known.sum(axis=0).all():
        speaks = (known.T @ bits + 0.5) / (known.sum(axis=0)[:, None] + 1)
        prior = known[:, 1].sum() / known.sum()
    free = np.maximum(counts - known.sum(axis=1), 0)
    shares = np.ones(VOTERS)
    for _ in range(rounds):
        weight = np.where(bits > 0, np.log(speaks[1] / speaks[0]), np.log((1 - speaks[1]) / (1 - speaks[0])))
        logit = np.log(prior / (1 - prior)) + weight @ shares
        p = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        mass = np.stack([free * (1 - p) + known[:, 0], free * p + known[:, 1]])
        speaks = np.clip((mass @ bits + 0.5) / (mass.sum(axis=1)[:, None] + 1), 1e-4, 1 - 1e-4)
        prior = np.clip(mass[1].sum() / max(mass.sum(), 1), 1e-3, 1 - 1e-3)
        together = np.zeros((VOTERS, VOTERS))
        for c in (0, 1):
            d = (bits - speaks[c]) * np.sqrt(mass[c] / max(mass[c].sum(), 1))[:, None]
            cov = d.T @ d
            scale = np.sqrt(np.outer(np.diag(cov), np.diag(cov)))
            together += np.where(scale > 1e-9, np.clip(cov / np.maximum(scale, 1e-9), 0, 1), 0) / 2
        np.fill_diagonal(together, 0)
        shares = 1 / (1 + together.sum(axis=1))
    return p


def fit(voted: DataFrame, p: dict[int, float], n_terms: int) -> np.ndarray:
    """Weights of terms and, last, the intercept: logistic regression on soft labels, those of the masks in p. voted: mask, found."""
    if not p:
        return np.zeros(n_terms + 1)
    classes = voted.sparkSession.createDataFrame([(m, float(x)) for m, x in p.items()], "mask int, p double")  # at most 2^VOTERS rows
    of_class = F.explode(F.array(F.struct(F.lit(1.0).alias("label"), F.col("p").alias("share")), F.struct(F.lit(0.0).alias("label"), (1 - F.col("p")).alias("share"))))
    # texts with the same terms are one row for each class, however many they are
    rows = voted.join(F.broadcast(classes), "mask").select("found", of_class.alias("c")).groupBy("found", "c.label").agg(F.sum("c.share").alias("weight"))
    terms = CountVectorizerModel.from_vocabulary([str(k) for k in range(n_terms)], inputCol="terms", outputCol="features")
    rows = terms.transform(written(rows, "counted").withColumn("terms", F.col("found").cast("array<string>")))
    model = LogisticRegression(weightCol="weight", regParam=PENALTY, standardization=False, maxIter=STEPS).fit(rows)
    return np.append(model.coefficients.toArray(), model.intercept)


def scores(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", carry: list[str] | None = None) -> DataFrame:
    """Per row: key, held_out (its label was not learned), score (0 to 1), predicted (1 if score >= 0.5).

    Null and empty texts get the score of a text without any term. Labels other than 0 and 1 and
    labels of unknown or null keys are left aside; without any labels only known insults and patterns
    count. Of several labels of a key the largest holds. Rows with a null key are scored (held_out is
    that of an empty text); repeated rows come out repeatedly; an empty table gives an empty one.
    Columns named in ``carry`` (key and text among them) come along in a struct column ``carried``, so that whole
    documents can be filtered by their scores without a join.
    """
    importable(docs.sparkSession)
    rows = text_rows(docs, key, text)
    known = labels.where(F.col(key).isNotNull() & F.col(label).isin(0, 1)).where(learnable(key)).groupBy(F.col(key).cast("long").alias(key)).agg(F.max(label).cast("long").alias("toxic"))
    known = written(known.join(rows.select(key).distinct(), key, "left_semi"), "known")
    if known.count() <= LABELLED_ROWS:
        known = F.broadcast(known)
    terms = find_terms(rows.join(known, key).select("text", "toxic"))
    terms += sorted(INSULTS.difference(terms))
    voted = written(votes(rows, terms, key, text), "votes")
    seen = {r.mask: r.n for r in voted.groupBy("mask").agg(F.count("*").alias("n")).collect()}  # at most 2^VOTERS rows
    masks = np.array(sorted(seen), np.int64)
    place = {m: k for k, m in enumerate(masks.tolist())}
    fixed = np.zeros((len(masks), 2))
    for r in voted.join(known, key).groupBy("mask", "toxic").agg(F.count("*").alias("n")).collect():
        fixed[place[r.mask], r.toxic] = r.n
    p = label_model(masks, np.array([seen[m] for m in masks.tolist()], float), fixed)
    weights = fit(voted, dict(zip(masks.tolist(), p.tolist())), len(terms))
    judged = [(~learnable(key)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")]
    if carry:
        found = scored_rows(docs, terms, weights, text, carry)
        return found.withColumn(key, F.col(f"carried.{key}")).select(key, *judged, "carried")
    share = docs.sparkSession.sparkContext.broadcast(weights)

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = pa.compute.list_value_length(batch.column(1)).to_numpy()
            w = share.value
            z = w[-1] + np.bincount(np.repeat(np.arange(len(size)), size), w[batch.column(1).flatten().to_numpy()], len(size))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(1 / (1 + np.exp(-np.clip(z, -500, 500))))], names=[key, "score"])

    return voted.select(key, "found").mapInArrow(score, f"{key} long, score double").select(key, *judged)
