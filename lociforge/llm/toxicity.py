"""Toxicity: a logistic classifier whose score may not depend on which group a sentence names.

Features are the presence of words and of words' first 4, 5 and 6 bytes (inflected insults keep their stems).  The ones that tell the
labels apart beyond chance (likelihood ratio) enter, and every identity term does.  Training minimises log loss, an L2 term and
a counterfactual term: for each labelled sentence that names a group, the term is swapped for every other one, with all the
features that it sets (word and prefixes), and the squared change of the logit is penalised, so that neutral mentions keep the score of the same sentence without them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lociforge.llm import textkit
from lociforge.llm.storage import materialize, release
from lociforge.llm.worker import tidy_call

#: Group names whose swapping must not move a score, in the languages of the corpus; a parameter of ``fit_toxicity``.
IDENTITY_TERMS = (
    "women", "men", "girls", "boys", "christians", "muslims", "jews", "hindus", "buddhists", "atheists", "immigrants", "refugees", "black", "white", "asian", "latino", "arab", "african", "european", "gay", "lesbian", "straight", "transgender", "disabled", "blind", "deaf", "old", "young",
    "frauen", "männer", "mädchen", "jungen", "christen", "muslime", "juden", "hindus", "buddhisten", "atheisten", "einwanderer", "flüchtlinge", "schwarze", "weiße", "asiaten", "araber", "afrikaner", "europäer", "schwule", "lesben", "behinderte", "blinde", "gehörlose", "alte", "junge",
    "femmes", "hommes", "filles", "garçons", "chrétiens", "musulmans", "juifs", "hindous", "bouddhistes", "athées", "immigrés", "réfugiés", "noirs", "blancs", "asiatiques", "arabes", "africains", "européens", "gays", "lesbiennes", "handicapés", "aveugles", "sourds", "vieux", "jeunes",
    "mujeres", "hombres", "niñas", "niños", "cristianos", "musulmanes", "judíos", "hindúes", "budistas", "ateos", "inmigrantes", "refugiados", "negros", "blancos", "asiáticos", "árabes", "africanos", "europeos", "lesbianas", "discapacitados", "ciegos", "sordos", "viejos", "jóvenes",
)
PREFIXES = (4, 5, 6)


def _hashed(column: pa.Array):
    """Per text: all its feature hashes (words and prefixes), not made distinct."""
    for part in textkit.words(column, textkit.PUNCT):
        kinds = [part.hashes(), *(part.hashes(k) ^ np.uint64(k) for k in PREFIXES)]
        yield part, np.stack(kinds)


def _feature_sets(column: pa.Array) -> pa.Array:
    out = []
    for part, kinds in _hashed(column):
        for a, b in zip(part.first[:-1], part.first[1:], strict=True):
            out.append(np.unique(kinds[:, a:b]).tobytes())
    return pa.array(out, pa.binary())


def _feature_lists(column: pa.Array) -> pa.Array:
    """The distinct features as lists of long."""
    sets = [np.frombuffer(b, np.int64) for b in _feature_sets(column).to_pylist()]
    ends = np.r_[0, np.cumsum([len(s) for s in sets], dtype=np.int64)].astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int64), *sets])))


@dataclass(frozen=True)
class ToxicityModel:
    """Sorted feature hashes, their weights and the intercept: at most ``max_features`` and the identity terms, 16 bytes each."""

    keys: np.ndarray
    weights: np.ndarray
    intercept: float

    def score(self, column: pa.Array) -> np.ndarray:
        out = np.full(len(column), self.intercept)
        if not len(self.keys):
            return 1 / (1 + np.exp(-out))
        for part, kinds in _hashed(column):
            at = np.searchsorted(self.keys, kinds)
            known = self.keys[np.minimum(at, len(self.keys) - 1)] == kinds
            _, word = np.nonzero(known)
            text = np.searchsorted(part.first, word, "right") - 1
            seen = np.unique(text * len(self.keys) + at[known])
            out[part.rows] += np.bincount(seen // len(self.keys), self.weights[seen % len(self.keys)], minlength=len(part.first) - 1)
        return 1 / (1 + np.exp(-out))


def identity_hashes(terms) -> np.ndarray:
    column = pa.array([t.lower() for t in terms], pa.string())
    return np.concatenate([p.hashes() for p in textkit.words(column, textkit.PUNCT)]) if len(column) else np.zeros(0, np.uint64)


def _term_features(terms, wanted: np.ndarray) -> np.ndarray:
    """A row per distinct term: 1 at each of the ``wanted`` features that it sets, as a word or by a prefix."""
    column = pa.array(sorted({t.lower() for t in terms}), pa.string())
    sets = [np.frombuffer(b, np.uint64) for b in _feature_sets(column).to_pylist()]
    return np.array([np.isin(wanted, found) for found in sets], float).reshape(len(sets), len(wanted))


def _ratio(count, pos, share):
    """The likelihood ratio (twice its log) of a feature's labels against the common share."""
    expected, rest = count * share, count - pos
    with np.errstate(divide="ignore", invalid="ignore"):
        return 2 * (np.where(pos > 0, pos * np.log(pos / expected), 0) + np.where(rest > 0, rest * np.log(rest / (count - expected)), 0))


def _chance(frequent: int) -> float:
    """A ratio that chance alone seldom reaches among so many features."""
    return max(10.0, 1.3 * np.log(max(1, frequent)))


def _constant(y: np.ndarray) -> ToxicityModel | None:
    """With one class only, the score is the smoothed share of toxic rows; without any, a low one."""
    if len(y) and y.min() != y.max():
        return None
    share = (y.sum() + 0.5) / (len(y) + 1)
    return ToxicityModel(np.zeros(0, np.uint64), np.zeros(0), float(np.log(share / (1 - share))) if len(y) else -3.0)


def fit_arrays(rows: list[tuple[bytes, int]], terms=IDENTITY_TERMS, max_features: int = 512, min_rows: int = 3, **how) -> ToxicityModel:
    """Fits on (distinct feature hashes, label) rows held in memory."""
    sets = [np.frombuffer(b, np.uint64) for b, _ in rows]
    y = np.array([t for _, t in rows], float)
    if (model := _constant(y)) is not None:
        return model
    keys, inverse = np.unique(np.concatenate(sets), return_inverse=True)
    count, pos = np.bincount(inverse), np.bincount(inverse, np.repeat(y, [len(s) for s in sets]))
    share = (y.sum() + 0.5) / (len(y) + 1)
    ratio, often = _ratio(count, pos, share), count >= min_rows
    chosen = np.flatnonzero(often & (ratio >= _chance(often.sum())) & (pos > count * share))
    chosen = chosen[np.lexsort((keys[chosen], -ratio[chosen]))][:max_features]
    return train(sets, y, keys[chosen], terms, **how)


def train(sets: list[np.ndarray], y: np.ndarray, features: np.ndarray, terms=IDENTITY_TERMS, l2: float = 0.5, swap_penalty: float = 25.0) -> ToxicityModel:
    """The logistic fit on the chosen features and the identity terms."""
    group = np.unique(identity_hashes(terms))
    wanted = np.union1d(features, group)
    share = (y.sum() + 0.5) / (len(y) + 1)
    x = np.zeros((len(sets), len(wanted) + 1))
    x[:, -1] = 1
    for i, found in enumerate(sets):
        x[i, np.flatnonzero(np.isin(wanted, found))] = 1
    penalty = np.diag(np.r_[np.full(len(wanted), l2), 1e-6])
    sets_of = _term_features(terms, wanted)
    words = np.isin(wanted, group)
    for t, mine in enumerate(sets_of):  # a sentence with term t, once for each other term in its place; every term counts one sentence more than it has
        change = mine - np.delete(sets_of, t, 0)
        named = 1 + x[:, :-1][:, words & (mine > 0)].all(1).sum()
        penalty[:-1, :-1] += swap_penalty * named / max(1, len(change)) * (change.T @ change)
    w = np.r_[np.zeros(len(wanted)), np.log(share / (1 - share))]
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + penalty @ w
        hessian = (x.T * np.maximum(p * (1 - p), 1e-4)) @ x + penalty
        step = np.linalg.solve(hessian + 1e-9 * np.eye(len(w)), gradient)
        w -= step * min(1.0, 4 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-6:
            break
    return ToxicityModel(wanted, w[:-1], float(w[-1]))


def held_out(doc: Column) -> Column:
    """The quarter whose labels are never learnt from: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(doc.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit_toxicity(docs: DataFrame, labels: DataFrame, max_rows: int = 4000, doc: str = "doc_id", text: str = "text", label: str = "toxic", terms=IDENTITY_TERMS, max_features: int = 512, min_rows: int = 3, **how) -> ToxicityModel:
    """Fits on at most about ``max_rows`` labelled rows outside ``held_out``, taken by a hash of the id.

    The share taken is max_rows / labelled rows, so it is all of them in a small corpus.  Null labels and ids are no examples; of an id's
    several labels 1 wins; each row of a repeated document counts.  Features are counted and chosen by an aggregation; to the driver come the chosen
    ones (``max_features``) and, per row, which of them and of the terms it has: bounded however long the texts are.
    """
    known = labels.select(F.col(doc).alias("_id"), F.col(label).cast("int").alias("_y")).where(F.col("_y").isin(0, 1) & F.col("_id").isNotNull() & ~held_out(F.col(doc)))
    known = known.groupBy("_id").agg(F.max("_y").alias("_y"))
    n = known.count()
    if n > max_rows:
        known = known.where(F.pmod(F.xxhash64("_id", F.lit(17)), F.lit(1 << 30)) < int(max_rows / n * (1 << 30)))
    rows = docs.select(F.col(doc).alias("_id"), F.col(text).alias("_t")).join(F.broadcast(known), "_id")  # of max_rows rows of 12 bytes
    rows = materialize(rows.select(F.arrow_udf(tidy_call(_feature_lists), "array<long>")("_t").alias("_f"), "_y"), "toxicity-rows")
    size, toxic = rows.agg(F.count("*"), F.coalesce(F.sum("_y"), F.lit(0))).first()
    if (model := _constant(np.repeat([1.0, 0.0], [toxic, size - toxic]))) is not None:
        release(rows)
        return model
    counted = rows.select(F.explode("_f").alias("f"), "_y").groupBy("f").agg(F.count("*").alias("n"), F.sum("_y").alias("pos")).where(F.col("n") >= min_rows)
    counted = materialize(counted, "toxicity-features")
    share = (toxic + 0.5) / (size + 1)
    seen, hit, expected = F.col("n"), F.col("pos"), F.col("n") * share
    part = lambda x, of: F.when(x > 0, x * F.log(x / of)).otherwise(0.0)
    ratio = 2 * (part(hit, expected) + part(seen - hit, seen - expected))
    best = counted.where((ratio >= float(_chance(counted.count()))) & (hit > expected)).orderBy(ratio.desc(), "f").limit(max_features)
    features = np.array([r[0] for r in best.select("f").collect()], np.int64).view(np.uint64)
    wanted = np.union1d(features, identity_hashes(terms)).view(np.int64).tolist()
    found = rows.select(F.filter("_f", lambda f: f.isin(wanted)), "_y").collect()
    for table in (rows, counted):
        release(table)
    return train([np.array(r[0], np.int64).view(np.uint64) for r in found], np.array([r[1] for r in found], float), features, terms, **how)


def toxicity_score(model: ToxicityModel, text: Column) -> Column:
    """Score of each whole text, 0 to 1; empty and null texts get the intercept's."""

    def score(column: pa.Array) -> pa.Array:
        return pa.array(model.score(column), pa.float64())

    return F.arrow_udf(tidy_call(score), "double")(text)
