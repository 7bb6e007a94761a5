"""Hierarchical language identification: linear SVMs tell the language family first, then
one-versus-one linear SVMs tell the languages of that family apart.

Features are hashed character 1- to 3-grams of the whole text, as shares of its n-grams. Being
linear in those shares, every classifier is one column of a weight table: a text's margins are
the mean of the table's rows at its n-grams, so prediction is a gather and a segment sum.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, id_text, releasing, small_batches, text_bytes

#: Families of ISO 639-1 codes; a code that isn't here is a family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af lb fy yi",
    "romance": "fr es it pt ro ca gl oc",
    "slavic": "ru uk be pl cs sk sl hr sr bs mk bg",
    "celtic": "ga gd cy br",
    "baltic": "lt lv",
    "uralic": "fi et hu",
    "turkic": "tr az kk uz ky tk",
    "indo-aryan": "hi bn mr gu pa ur ne",
    "semitic": "ar he am mt",
    "sinitic": "zh",
}
FAMILY = {code: name for name, codes in FAMILIES.items() for code in codes.split()}
DIM = 1 << 14
#: Bound of the labelled sample that the classifiers are fitted on, in rows a language.
PER_LANGUAGE = 500
ORDERS = 3

_letter: np.ndarray | None = None


def letters() -> np.ndarray:
    global _letter
    if _letter is None:
        _letter = np.frombuffer(bytes(chr(i).isalpha() for i in range(0x110000)), np.uint8).astype(bool)
    return _letter


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed n-grams (a row per position, a column per order), first position of each text (one
    more at the end) and whether a text has a letter. Other characters than letters are blanks."""
    low = [t.lower() + "\n" for t in texts]
    c = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), "<u4")
    n = np.array([len(t) for t in low], np.int64)
    off = np.concatenate([[0], np.cumsum(n)])
    is_letter = letters()[c]
    has = np.add.reduceat(is_letter, off[:-1]) > 0 if len(texts) else np.zeros(0, bool)
    c = np.where(is_letter, c, 0).astype(np.uint32)
    h = c * np.uint32(2654435761)
    out = np.empty((len(c), ORDERS), np.uint16)
    out[:, 0] = h >> np.uint32(18)
    for k in range(1, ORDERS):
        nxt = np.zeros_like(c)
        nxt[:-k] = c[k:]
        h = (h ^ (nxt + np.uint32(k * 0x9E37))) * np.uint32(2246822519)
        h ^= h >> np.uint32(15)
        out[:, k] = (h * np.uint32(2654435761)) >> np.uint32(18)
    return out, off, has


def shares(texts: list[str]):
    """Sparse shares (index, value) of each text, for training."""
    for t in texts:
        g, _, _ = grams([t])
        idx, n = np.unique(g, return_counts=True)
        yield idx.astype("<i4"), (n / g.size).astype("<f4")


def svm(kernel: np.ndarray, y: np.ndarray, cost: float = 10.0, epochs: int = 30) -> np.ndarray:
    """Dual coordinate descent for the linear SVM with hinge loss; returns alpha * y. Classes
    are weighted to the same total."""
    n = len(y)
    limit = np.where(y > 0, n / max(1, 2 * (y > 0).sum()), n / max(1, 2 * (y < 0).sum())) * cost
    alpha, f, diag = np.zeros(n), np.zeros(n), kernel.diagonal() + 1e-12
    rng = np.random.default_rng(7)
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(n):
            new = min(limit[i], max(0.0, alpha[i] - (y[i] * f[i] - 1) / diag[i]))
            d = new - alpha[i]
            if abs(d) > 1e-9:
                f += d * y[i] * kernel[:, i]
                alpha[i] = new
                moved = max(moved, abs(d))
        if moved < 1e-4 * cost:
            break
    return alpha * y


class Model:
    """families: names; members: languages by family; table: DIM + 1 rows (the last is the bias),
    a column per classifier: one per family (against the others), then each pair in a family."""

    def __init__(self, x: np.ndarray, labels: list[str]):
        langs = sorted(set(labels))
        self.members: dict[str, list[str]] = {}
        for code in langs:
            self.members.setdefault(FAMILY.get(code.lower().split("-")[0], code), []).append(code)
        self.families = sorted(self.members)
        scale = 1 / np.sqrt(x.mean(axis=0, dtype=np.float64) + 1e-5) if len(x) else np.ones(DIM)
        x *= scale.astype(np.float32)  # in place: the largest array of the driver
        kernel = (x @ x.T).astype(np.float64) + 1.0
        labels = np.array(labels)
        fam = np.array([FAMILY.get(v.lower().split("-")[0], v) for v in labels])
        columns, self.pairs = [], []

        def fit(on: np.ndarray, plus: np.ndarray):
            y = np.where(plus[on], 1.0, -1.0)
            a = np.zeros(len(labels), np.float32)
            a[on] = svm(kernel if len(on) == len(labels) else kernel[np.ix_(on, on)], y)
            columns.append(np.append((a @ x) * scale, a.sum()))

        everything = np.arange(len(labels))
        if len(self.families) > 1:
            for name in self.families:
                fit(everything, fam == name)
        for name in self.families:
            for a, b in combinations(self.members[name], 2):
                self.pairs.append((name, a, b))
                fit(np.flatnonzero((labels == a) | (labels == b)), labels == a)
        self.table = np.array(columns, np.float32).T if columns else np.zeros((DIM + 1, 0), np.float32)

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        if not self.families:
            return ["und"] * len(texts), [0.0] * len(texts)
        g, off, has = grams(texts)
        margin = np.zeros((len(texts), self.table.shape[1]))
        if len(texts) and margin.shape[1]:
            total = np.zeros((len(g), self.table.shape[1]), np.float32)
            for k in range(ORDERS):
                total += self.table[g[:, k]]
            margin = np.add.reduceat(total, off[:-1], axis=0, dtype=np.float64) / (np.diff(off)[:, None] * ORDERS) + self.table[-1]
        p = 1 / (1 + np.exp(-2 * np.clip(margin, -30, 30)))
        n = len(self.families) if len(self.families) > 1 else 0
        lang, score = [], []
        column = {pair: n + i for i, pair in enumerate(self.pairs)}
        for i in range(len(texts)):
            if not has[i]:
                lang.append("und")
                score.append(0.0)
                continue
            which = int(margin[i, :n].argmax()) if n else 0
            sure = float(p[i, which]) if n else 1.0
            name = self.families[which]
            votes = {v: [0, 0.0, 1.0] for v in self.members[name]}
            for a, b in combinations(self.members[name], 2):
                q = p[i, column[name, a, b]]
                for v, w in ((a, q), (b, 1 - q)):
                    votes[v][0] += w > 0.5
                    votes[v][1] += w
                    votes[v][2] = min(votes[v][2], float(w))
            best = max(sorted(votes), key=lambda v: (votes[v][0], votes[v][1]))
            lang.append(best)
            score.append(sure * votes[best][2])
        return lang, score


def train(docs: DataFrame, per_language: int = PER_LANGUAGE, lang_col: str = "lang", text_col: str = "text", id_col: str = "doc_id") -> Model:
    """Fit on about ``per_language`` rows of each language (chosen by a hash of the row; all, if
    there are fewer), whole texts. Texts without content teach nothing."""
    rows = docs.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"), F.xxhash64(id_col, text_col).alias("h")).where("text is not null and lang is not null")
    rates = {r["lang"]: min(1.0, per_language / r["n"]) for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not rates:
        return Model(np.zeros((0, DIM), np.float32), [])
    rate = F.create_map(*[F.lit(x) for kv in rates.items() for x in kv])
    picked = rows.where((F.pmod("h", F.lit(1 << 40)) / float(1 << 40)) < F.try_element_at(rate, F.col("lang")))

    def sparse(batches):
        for b in batches:
            found = [(i.tobytes(), v.tobytes()) for i, v in shares(b.column("text").to_pylist())]
            yield pa.record_batch([b.column("lang"), b.column("h"), *(pa.array([x[k] for x in found], pa.binary()) for k in (0, 1))], names=["lang", "h", "idx", "val"])

    got = picked.mapInArrow(releasing(sparse), "lang string, h long, idx binary, val binary").toArrow().sort_by([("lang", "ascending"), ("h", "ascending")])
    x = np.zeros((got.num_rows, DIM), np.float32)
    for r, (i, v) in enumerate(zip(got["idx"], got["val"], strict=True)):
        x[r, np.frombuffer(i.as_buffer(), "<i4")] = np.frombuffer(v.as_buffer(), "<f4")
    labels = got["lang"].to_pylist()
    del got
    return Model(x, labels)


def _predict(model: Model, col: pa.Array) -> tuple[list[str], list[float]]:
    _, off = text_bytes(col)
    texts, lang, score = col.to_pylist(), [], []
    for i, j in chunks(off):
        a, s = model.predict([t or "" for t in texts[i:j]])
        lang += a
        score += s
    return lang, score


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, lang_pred, score. Null texts and texts without a letter are
    ``und`` with score 0; a model that learned nothing says ``und`` to all. Repeated rows and null
    ids stay; other columns are not read. An empty table gives no rows."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches):
        for b in batches:
            lang, score = _predict(shared.value, b.column(1))
            yield pa.record_batch([b.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64())], names=["doc_id", "lang_pred", "score"])

    base = id_text(docs, id_col, text_col)
    return base.mapInArrow(releasing(predict), "doc_id long, lang_pred string, score double")


def keep_identified(docs: DataFrame, model: Model, text_col: str = "text", least: float = 0.0) -> DataFrame:
    """The rows, with all their columns, whose text has a language: ``und`` goes, and so does a
    score below ``least``. A model that learned nothing only rejects texts without a letter."""
    small_batches(docs.sparkSession)
    shared, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text_col)

    def keep(batches):
        for b in batches:
            lang, score = _predict(shared.value, b.column(at))
            if not shared.value.families:
                lang = ["any" if t is not None and any(map(str.isalpha, t)) else "und" for t in b.column(at).to_pylist()]
            yield b.filter(pa.array([v != "und" and s >= least for v, s in zip(lang, score, strict=True)], pa.bool_()))

    return docs.mapInArrow(releasing(keep), docs.schema)
