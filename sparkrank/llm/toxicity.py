"""Toxicity by weak supervision.

1. Terms: from a bounded sample of labelled rows, the words and word beginnings that occur
   in toxic rows far more often than in others (likelihood-ratio test), counted in Spark.
2. Voters: many lexicons (the terms in order of strength, cut into lists, and small fixed word lists) vote
   "toxic" when a text has one of their terms; patterns (shouting, exclamation runs, insults
   in the second person, drawn-out letters) vote too; the absence of all terms votes "clean".
3. A generative label model explains the votes by a hidden class: accuracies (the
   distribution of each voter's votes in each class) by expectation maximisation, and pairwise
   correlations of the voters within the classes; a voter's evidence is divided by the root of
   one plus its correlations, so that voters which repeat each other do not count twice.
4. A linear classifier over the terms and patterns is trained on the posterior labels, and
   scores every whole text; a row is predicted toxic at ``THRESHOLD`` (0.7).

Gold labels are used to mine terms, for the class prior and as a prior of the accuracies; language, source and
ids are inputs of no step. The sample is at most ``SAMPLE_ROWS`` labelled rows in expectation,
chosen by hash; its votes and term occurrences are all that reaches the driver.

Edge cases: a null text scores as an empty one; without labelled rows, or without any toxic
one, every score is the class prior (0 without rows); labels that are null are ignored, ids
labelled more than once count as toxic if most of their labels are; repeated rows get equal
scores; an empty table gives an empty result; extra columns pass through.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, fold, prepare, release_memory, table

SAMPLE_ROWS = 12_000
MAX_TERMS = 4096
LEXICONS = 32
MIN_ROWS = 5
#: A term also has to occur in this share of the toxic rows: the words that a few copies of one
#: toxic text share by chance do not.
MIN_SHARE = 0.02
MIN_G2 = 24.0
MIN_LIFT = 15.0
THRESHOLD = 0.7
ANCHOR = 0.5
_WORD = re.compile(r"[^\W\d_]+")
BEGINNINGS = (4, 5, 6, 7)
TIMES = (1, 2, 3, 5)
#: Lengths in words, inputs of the classifier: a long text meets any term by chance sooner.
LENGTHS = (100, 400, 1600, 6400)

#: Small word lists, each a voter.
SEEDS = (
    ("idiot", "moron", "stupid", "imbecile", "dumb", "fool"),
    ("loser", "pathetic", "worthless", "useless", "failure"),
    ("scum", "trash", "garbage", "filth", "vermin"),
    ("disgusting", "repulsive", "vile", "gross"),
    ("clown", "joke", "freak", "creep"),
    ("hate", "kill", "die", "hurt"),
    ("idiota", "imbécil", "estúpido", "basura", "asco"),
    ("crétin", "débile", "ordure", "abruti", "connard"),
    ("dummkopf", "abschaum", "trottel", "widerlich", "versager"),
)
PATTERNS = (
    ("shouting", re.compile(r"(?:\b[A-Z]{4,}\b\W+){3}")),
    ("exclaiming", re.compile(r"[!?]{3}")),
    ("insulting", re.compile(r"\b(?:you|u)(?:'re| are| r)\s+(?:(?:such|so|just|all|a|an|the)\s+){0,2}\w+", re.I)),
    ("drawn out", re.compile(r"([A-Za-z])\1{3}")),
    ("silencing", re.compile(r"\b(?:shut up|go away|get lost|nobody asked)\b", re.I)),
)


def _beginnings(words: Counter, known=None) -> Counter:
    """How many words start with each beginning (of the known ones)."""
    out: Counter = Counter()
    for w, n in words.items():
        for k in BEGINNINGS:
            if len(w) >= k and (known is None or w[:k] in known):
                out[w[:k]] += n
    return out


def features(text: str) -> set[str]:
    """Distinct lower-case words (``=word``) of a whole text, and the beginnings that at least
    so many of its words have (``word^2``)."""
    words = Counter(_WORD.findall(text.lower()))
    out = {f"={w}" for w in words if 2 < len(w) <= 24}
    out.update(f"{p}^{t}" for p, n in _beginnings(words).items() for t in TIMES if n >= t)
    return out


def patterns(text: str) -> list[bool]:
    """Which patterns occur; then which lengths are reached."""
    n = text.count(" ") + 1
    return [bool(p.search(text)) for _, p in PATTERNS] + [n >= k for k in LENGTHS]


class Classifier:
    """Weights of the terms and patterns, and the bias; plain data, small enough to ship."""

    def __init__(self, bias: float = -30.0, terms: dict[str, float] | None = None, others: list[float] | None = None):
        self.bias, self.terms, self.others = bias, terms or {}, others or [0.0] * (len(PATTERNS) + len(LENGTHS))
        self.starts: dict[str, list[tuple[int, float]]] = {}
        for t, w in self.terms.items():
            if not t.startswith("="):
                start, times = t.split("^")
                self.starts.setdefault(start, []).append((int(times), w))

    def score(self, text: str) -> float:
        z = self.bias
        if self.terms:
            words = Counter(_WORD.findall(text.lower()))
            get = self.terms.get
            own = [w for w in (get("=" + x) for x in words) if w is not None]
            own += [w for p, n in _beginnings(words, self.starts).items() for t, w in self.starts[p] if n >= t]
            z += math.fsum(own + [w for w, hit in zip(self.others, patterns(text)) if hit])
        return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, z))))


def _features_of(texts: pa.Array) -> pa.Array:
    return pa.array([sorted(features(t.as_py() or "")) for t in texts], type=pa.list_(pa.string()))


def _patterns_of(texts: pa.Array) -> pa.Array:
    return pa.array([patterns(t.as_py() or "") for t in texts], type=pa.list_(pa.bool_()))


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """``(row, toxic, text)``: about ``rows`` labelled documents, chosen by a hash of the id."""
    per_id = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.round(F.avg("toxic")).cast("int").alias("toxic"))
    n = per_id.count()
    share = min(1.0, rows / max(1, n))
    # Fine enough for any number of ids: a share of a few rows is not rounded away.
    picked = cut(per_id.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) < math.ceil(share * (1 << 40))), "label-sample")
    if n and picked.isEmpty():
        raise ValueError(f"no row in the sample of {rows} of {n} labelled ids")
    text = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # One text per id, so an id that very many rows share does not outgrow the bound.
    joined = text.join(F.broadcast(picked), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    return joined.select(F.col("doc_id").alias("row"), "toxic", "text")


def mine_terms(sample: DataFrame) -> tuple[DataFrame, list[str]]:
    """The sample's ``(row, toxic, terms, patterns)`` and the terms, strongest first."""
    made = sample.select("row", "toxic", F.arrow_udf(_features_of, "array<string>")("text").alias("f"), F.arrow_udf(_patterns_of, "array<boolean>")("text").alias("patterns"))
    made = cut(made, "sample-features")
    size = made.agg(F.sum("toxic"), F.count("*")).first()
    pos, n = size[0] or 0, size[1]
    if not pos or pos == n:
        return made.select("row", "toxic", F.array().cast("array<string>").alias("terms"), "patterns"), []
    hits = made.select("toxic", F.explode("f").alias("term")).groupBy("term").agg(F.sum("toxic").alias("a"), F.count("*").alias("c")).where(F.col("a") >= max(MIN_ROWS, MIN_SHARE * pos))
    rate = pos / n
    log_term = lambda k, m: F.when(k > 0, k * F.log(k / m)).otherwise(0.0)
    b = F.col("c") - F.col("a")
    g2 = 2 * (log_term(F.col("a"), F.col("c") * rate) + log_term(b, F.col("c") * (1 - rate)))
    # Much likelier in toxic rows, and beyond chance.
    lift = (F.col("a") / pos) / ((b + 0.5) / (n - pos + 1))
    strong = hits.withColumn("g2", g2).where((F.col("g2") >= MIN_G2) & (lift >= MIN_LIFT)).orderBy(F.desc("g2"), F.desc(F.length("term")), "term").limit(MAX_TERMS)
    terms = [r["term"] for r in strong.collect()]
    kept = F.array_intersect("f", F.array(*map(F.lit, terms))) if terms else F.array().cast("array<string>")
    return made.select("row", "toxic", kept.alias("terms"), "patterns"), terms


def without_echoes(terms: list[list[str]], order: list[str], most: float = 0.85) -> list[str]:
    """The terms without those that occur in nearly the same rows as a kept one (Jaccard).

    Terms are visited by strength as given; of equal ones the longer says it more safely.
    """
    at = {t: i for i, t in enumerate(order)}
    seen = np.zeros((len(terms), len(order)), dtype=np.float32)
    for i, ts in enumerate(terms):
        seen[i, [at[t] for t in ts if t in at]] = 1
    both, size = seen.T @ seen, seen.sum(axis=0)
    alike = both / np.maximum(size[:, None] + size[None] - both, 1) >= most
    kept: list[int] = []
    for i in range(len(order)):
        if not alike[i, kept].any():
            kept.append(i)
    return [order[i] for i in kept]


def vote(terms: list[list[str]], hits: np.ndarray, order: list[str]) -> np.ndarray:
    """Votes of every voter on every row: 1 toxic, -1 clean, 0 nothing to say."""
    rank = {t: i for i, t in enumerate(order)}
    lexicons = min(LEXICONS, max(1, len(order)))
    seed_of = {f"={w}": k for k, words in enumerate(SEEDS) for w in words}
    out = np.zeros((len(terms), lexicons + len(SEEDS) + hits.shape[1] + 1), dtype=np.int8)
    for i, ts in enumerate(terms):
        for t in ts:
            if t in rank:
                out[i, rank[t] * lexicons // len(order)] = 1
            if t in seed_of:
                out[i, lexicons + seed_of[t]] = 1
        out[i, -1] = 0 if ts else -1
    out[:, lexicons + len(SEEDS) : -1] = hits
    return out


def label_model(
    votes: np.ndarray, prior: float, gold: np.ndarray | None = None, rounds: int = 2, steps: int = 40
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(posterior, accuracies, correlations)`` from the votes and the class prior.

    ``gold`` labels, where given, are a prior of the accuracies that counts ``ANCHOR`` times as
    much as the rows: without it a voter that is alone on its rows could not be told from chance.
    """
    n, m = votes.shape
    shown = np.stack([votes == v for v in (-1, 0, 1)], axis=2).astype(float)  # row, voter, vote
    weight, corr = np.ones(m), np.zeros((m, m))
    known = [np.full(n, 1e-9) if gold is None else ANCHOR * (gold == k) + 1e-9 for k in (0, 1)]
    anchor = [np.einsum("i,ijv->jv", w, shown) for w in known]
    q = np.where(votes.sum(axis=1, dtype=int) > 0, 0.9, 0.5 * prior)  # start from the majority
    for _ in range(rounds):
        for _ in range(steps):
            p = [(np.einsum("i,ijv->jv", w, shown) + a + 0.5) / (w.sum() + k.sum() + 1.5) for w, a, k in zip((1 - q, q), anchor, known)]
            ratio = np.log(p[1]) - np.log(p[0])
            ratio[:, 1] = 0  # saying nothing is no evidence
            evidence = (shown * ratio[None]).sum(axis=2) @ weight
            new = 1 / (1 + np.exp(-np.clip(evidence + math.log(prior / (1 - prior)), -30, 30)))
            moved, q = np.abs(new - q).max(), new
            if moved < 1e-6:
                break
        # Correlation that the classes do not explain.
        mean = np.stack([p[k][:, 2] - p[k][:, 0] for k in (0, 1)])
        rest = votes - (np.outer(1 - q, mean[0]) + np.outer(q, mean[1]))
        scale = np.sqrt((rest**2).mean(axis=0)) + 1e-9
        corr = (rest.T @ rest) / n / np.outer(scale, scale)
        np.fill_diagonal(corr, 0)
        weight = 1 / np.sqrt(1 + np.where(corr > 0.1, corr, 0).sum(axis=1))
    return q, np.stack(p), corr


def fit_linear(rows: list[list[int]], width: int, target: np.ndarray, steps: int = 1000, l2: float = 3e-5) -> np.ndarray:
    """Logistic regression on soft labels; ``rows`` list the set inputs, the last weight is the bias."""
    n = len(rows)
    row = np.repeat(np.arange(n), [len(r) for r in rows])
    col = np.array([c for r in rows for c in r], dtype=np.int64)
    w, past = np.zeros(width + 1), np.full(width + 1, 1e-8)
    w[-1] = math.log((target.mean() + 1e-6) / (1 - target.mean() + 1e-6))
    for _ in range(steps):
        z = w[-1] + np.bincount(row, w[col], minlength=n)
        gap = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - target
        g = np.append(np.bincount(col, gap[row], minlength=width), gap.sum()) / n + l2 * np.append(w[:-1], 0)
        past += g * g
        w -= 0.5 * g / np.sqrt(past)
    return w


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Classifier:
    """Terms, voters, label model and classifier from the labelled rows given."""
    prepare(docs.sparkSession)
    made, order = mine_terms(labelled_sample(docs, labels, rows))
    got = made.orderBy("row").toArrow().to_pylist()  # bounded by the sample and the mined terms
    if not got:
        return Classifier()
    prior = sum(r["toxic"] for r in got) / len(got)
    if not order:
        return Classifier(bias=math.log((prior + 1e-9) / (1 - prior + 1e-9)) if prior < 1 else 30.0)
    hits = np.array([r["patterns"] for r in got], dtype=bool)
    # Whole words are visited first: a beginning that says the same also meets other words.
    order = without_echoes([r["terms"] for r in got], sorted(order, key=lambda t: not t.startswith("=")))
    posterior, _, _ = label_model(vote([r["terms"] for r in got], hits[:, : len(PATTERNS)], order), prior, np.array([r["toxic"] for r in got]))
    at = {t: i for i, t in enumerate(order)}
    inputs = [[at[t] for t in r["terms"] if t in at] + [len(order) + int(k) for k in np.nonzero(h)[0]] for r, h in zip(got, hits)]
    w = np.round(fit_linear(inputs, len(order) + hits.shape[1], posterior), 6)
    return Classifier(float(w[-1]), {t: float(w[i]) for t, i in at.items()}, w[len(order) : -1].tolist())


def score(docs: DataFrame, model: Classifier, text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with ``out``: the classifier's probability for every whole text."""
    spark = docs.sparkSession
    prepare(spark)
    shared = spark.sparkContext.broadcast(model)  # at most MAX_TERMS weights

    def run(texts: pa.Array) -> pa.Array:
        one = shared.value.score
        found = pa.array([one(t.as_py() or "") for t in texts], type=pa.float64())
        release_memory()
        return found

    return docs.withColumn(out, F.arrow_udf(run, "double")(F.col(text_col)))


def train_on_open_fold(docs: DataFrame, labels: DataFrame) -> Classifier:
    """A classifier from the labels of the rows outside the held-out fold."""
    return train(docs, labels.where(fold("doc_id", 3) != 1))


def q_op4_toxicity(spark, sf_dir) -> DataFrame:
    """Toxicity of every document, learned from the labels outside the held-out fold."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train_on_open_fold(docs, table(spark, sf_dir, "labels"))
    return score(docs, model).select(
        "doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
