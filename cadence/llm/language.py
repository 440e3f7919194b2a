"""Language identification in two steps: family first, then one-versus-one linear SVMs inside it.

A text is a vector of hashed character trigrams (lower case, everything that is not a letter
read as one space), square roots of their shares, so its length is one. Families are told
apart by linear support vector machines, one per pair of families; the languages of the
family that wins are told apart by one machine per pair of them. Where there are more than `FAN`
families, or languages in one, the likest (by their mean vectors) are put into at most `FAN`
groups, told apart first, and so on: any number of languages makes a tree whose nodes have at
most 120 machines. Machines are fitted in Spark tasks by dual coordinate descent on a bounded sample
of the labelled rows: at most `SAMPLE` different texts a language and `TOTAL` in all, but one of every
language, those with the smallest hash (production parameter; all else covers all rows). They are
written to the shared folder, and a worker loads the nodes that its texts reach. The driver holds
the languages' names and the sample, no machine. Scoring reads every whole text once, in Arrow
batches, and moves nothing.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import lru_cache
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadence.llm.common import crc_mod, query, read, shared_folder
from cadence.llm.warc import _store

# Language families by ISO 639-1 code. A tag goes by its first part, in any case (en-US:
# en). A language not listed is a family of its own.
FAMILIES = {
    "en": "germanic", "de": "germanic", "nl": "germanic", "sv": "germanic", "da": "germanic", "no": "germanic",
    "fr": "romance", "es": "romance", "it": "romance", "pt": "romance", "ro": "romance", "ca": "romance",
    "ru": "slavic", "pl": "slavic", "cs": "slavic", "uk": "slavic", "bg": "slavic", "sk": "slavic",
}
SAMPLE = 600        # labelled documents a language, at most
TOTAL = 12_000      # labelled documents of all languages together, at most (or one a language)
FAN = 16            # children of a node, at most: 120 machines, 4 MB
NODES_HELD = 16     # nodes a worker keeps in memory
SKETCH = 256        # numbers by which languages are compared for grouping
WIDTH = 8192        # hashed trigrams
SHARPNESS = 4.0     # margin to probability
UNKNOWN = "und"
HASHES = 1 << 40

_OTHER = re.compile(r"[\W\d_]+")


def has_letter(text: str) -> bool:
    """Whether a character of a Unicode letter category occurs (as \\p{L} has it: no digits, fractions, numerals)."""
    return any(map(str.isalpha, text))


def trigram_counts(text: str) -> np.ndarray:
    body = f" {_OTHER.sub(' ', text.lower())} ".encode("utf-8", "surrogatepass")
    b = np.frombuffer(body, np.uint8).astype(np.uint32)
    code = b[:-2] << np.uint32(16) | b[1:-1] << np.uint32(8) | b[2:]
    return np.bincount((code * np.uint32(2_654_435_761)) >> np.uint32(32 - WIDTH.bit_length() + 1), minlength=WIDTH)


def vector(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, values) of the entries that are not zero; the bias comes last."""
    place = np.flatnonzero(counts)
    return np.append(place, WIDTH), np.append(np.sqrt(counts[place] / counts.sum()), 1).astype(np.float32)


def fit_svm(x: list[tuple], y: np.ndarray, c: float = 4.0, epochs: int = 30, seed: int = 7) -> np.ndarray:
    """Weights (and bias, last) of a linear machine with squared hinge loss; ``x`` as `vector` gives
    it, y is +1 or -1. Both sides weigh alike, whatever their numbers."""
    share = np.where(y > 0, (y > 0).mean(), (y < 0).mean())
    diagonal = 1 / (2 * c * 0.5 / share)
    norm = np.array([(v * v).sum() for _, v in x]) + diagonal
    w, alpha, rng = np.zeros(WIDTH + 1, np.float32), np.zeros(len(x)), np.random.default_rng(seed)
    for _ in range(epochs):
        largest = 0.0
        for i in rng.permutation(len(x)):
            place, value = x[i]
            gradient = y[i] * (value @ w[place]) - 1 + diagonal[i] * alpha[i]
            step = max(alpha[i] - gradient / norm[i], 0.0) - alpha[i]
            if step:
                alpha[i] += step
                w[place] += np.float32(step * y[i]) * value
                largest = max(largest, abs(step))
        if largest < 1e-3:
            break
    return w


@lru_cache(NODES_HELD)
def load_node(folder: str, node: int) -> np.ndarray:
    """Weights of a node's machines, a column each, in the order of the pairs of its children."""
    files, path = _store(folder)
    t = pq.read_table(f"{path}/node={node}", filesystem=files, columns=["pair", "weights"], partitioning=None).sort_by("pair")
    return np.ascontiguousarray(np.stack([np.frombuffer(w.as_py(), np.float32) for w in t["weights"]]).T)


@dataclass
class LanguageModel:
    """``nodes``: children of each node, a language's name or the number of another node; node 0
    is the root. ``folder`` holds the machines of every node, one a pair of children; positive
    margins speak for the first."""
    families: dict[str, list[str]]
    nodes: list[list[str | int]]
    folder: str

    @staticmethod
    def _winner(n: int, margin: np.ndarray) -> tuple[int, float]:
        votes, sums, least = [0] * n, [0.0] * n, [np.inf] * n
        for (a, b), m in zip(combinations(range(n), 2), margin.tolist()):
            votes[a if m >= 0 else b] += 1
            sums[a] += m
            sums[b] -= m
            least[a], least[b] = min(least[a], m), min(least[b], -m)
        best = max(range(n), key=lambda k: (votes[k], sums[k]))
        return best, float(1 / (1 + np.exp(-SHARPNESS * least[best])))

    def predict_all(self, texts: list[str | None]) -> list[tuple[str, float]]:
        out, at = [(UNKNOWN, 0.0)] * len(texts), {}
        for i, t in enumerate(texts):
            if t is not None and self.families and has_letter(t):
                at.setdefault(0, []).append((i, vector(trigram_counts(t)), 1.0))
        while at:
            # All texts at a node together: it is loaded once a batch.
            node = min(at)
            children, rows = self.nodes[node], at.pop(node)
            weights = load_node(self.folder, node) if len(children) > 1 else None
            for i, (place, value), p in rows:
                k, q = (0, 1.0) if weights is None else self._winner(len(children), value @ weights[place])
                if isinstance(children[k], str):
                    out[i] = children[k], p * q
                else:
                    at.setdefault(children[k], []).append((i, (place, value), p * q))
        return out

    def predict(self, text: str | None) -> tuple[str, float]:
        return self.predict_all([text])[0]


def family_of(lang: str, families: dict[str, str] = FAMILIES) -> str:
    return families.get(lang) or families.get(re.split("[-_]", lang.lower())[0], lang)


def alike(sketches: np.ndarray) -> list[np.ndarray]:
    """Numbers of the rows in at most FAN groups of like rows and about equal size: halves along the
    direction in which the rows differ most, halved again."""
    parts = [np.arange(len(sketches))]
    while len(parts) * 2 <= FAN:
        halves = []
        for p in parts:
            x = sketches[p] - sketches[p].mean(axis=0)
            direction = np.linalg.eigh(x.T @ x)[1][:, -1]
            order = p[np.argsort(x @ direction, kind="stable")]
            halves += [np.sort(order[:len(p) // 2]), np.sort(order[len(p) // 2:])]
        parts = halves
    return parts


def grow(groups: dict[str, list[str]], sketch: dict[str, np.ndarray]) -> tuple[list[list], list[list[list[str]]]]:
    """(children of each node, languages below each child of each node)."""
    nodes, below = [], []

    def add(children: list[tuple]) -> int:
        """``children``: (languages below, what to add for them; None: a single language)."""
        node = len(nodes)
        nodes.append([])
        if len(children) > FAN:
            parts = alike(np.stack([np.mean([sketch[x] for x in ls], axis=0) for ls, _ in children]))
            children = [([x for k in p for x in children[k][0]], [children[k] for k in p]) for p in parts]
        below.append([ls for ls, _ in children])
        nodes[node] = [ls[0] if inner is None else add(inner) for ls, inner in children]
        return node

    add([(ls, [([x], None) for x in ls]) for ls in groups.values()])
    return nodes, below


def fit(labelled: DataFrame, families: dict[str, str] = FAMILIES, per_language: int = SAMPLE) -> LanguageModel:
    """Model from rows with text and lang; rows without language or without a letter are
    left out. No labelled row: a model that answers `und`. One language: always that one."""
    spark = labelled.sparkSession
    usable = labelled.filter("lang is not null and text is not null").filter(F.col("text").rlike(r"\p{L}"))
    # Different texts count, not rows: a text that is there thousands of times is one candidate.
    usable = usable.select("text", "lang", F.pmod(F.xxhash64("text"), F.lit(HASHES)).alias("__spot"))
    sizes = {r.lang: r["count"] for r in usable.select("lang", "__spot").distinct().groupBy("lang").count().collect()}
    names = sorted(sizes)
    if not names:
        return LanguageModel({}, [], "")
    per_language = max(1, min(per_language, TOTAL // len(names)))
    # A threshold on the hash leaves a little more than the sample; only that much is ranked.
    most = spark.createDataFrame([(n, int(HASHES * min(1.0, (1.5 * per_language + 100) / sizes[n]))) for n in names],
                                 "lang string, __most long")
    few = (usable.join(F.broadcast(most), "lang").filter(F.col("__spot") < F.col("__most"))
           .groupBy("lang", "__spot").agg(F.first("text").alias("text")))
    ranked = F.row_number().over(Window.partitionBy("lang").orderBy("__spot"))
    few = few.withColumn("__rank", ranked).filter(F.col("__rank") <= per_language)

    @F.pandas_udf("struct<place: array<int>, n: array<int>>")
    def counted(text: pd.Series) -> pd.DataFrame:
        counts = [trigram_counts(t) for t in text]
        return pd.DataFrame({"place": [np.flatnonzero(c).astype(np.int32) for c in counts],
                             "n": [c[c > 0].astype(np.int32) for c in counts]})

    # At most TOTAL rows, or one of each language.
    rows = few.select("lang", "__rank", counted("text").alias("c")).select("lang", "__rank", "c.place", "c.n").toArrow()
    rows = rows.sort_by([("lang", "ascending"), ("__rank", "ascending")]).combine_chunks()
    x, of, sketch = [], {}, {n: np.zeros(SKETCH, np.float32) for n in names}
    for i, (lang, place, n) in enumerate(zip(rows["lang"].to_pylist(), rows["place"], rows["n"])):
        place, n = place.values.to_numpy(), n.values.to_numpy()
        x.append((np.append(place, np.int32(WIDTH)), np.append(np.sqrt(n / n.sum()), 1).astype(np.float32)))
        of.setdefault(lang, []).append(i)
        np.add.at(sketch[lang], place % SKETCH, x[i][1][:-1])
    for n in names:
        sketch[n] /= max(len(of.get(n, [])), 1)
    groups: dict[str, list[str]] = {}
    for n in names:
        groups.setdefault(family_of(n, families), []).append(n)
    nodes, below = grow(groups, sketch)
    members = [[np.array([i for n in ls for i in of.get(n, [])], np.int64) for ls in child] for child in below]
    machines = [(node, pair, a, b) for node, child in enumerate(below)
                for pair, (a, b) in enumerate(combinations(range(len(child)), 2))]
    model = LanguageModel(groups, nodes, shared_folder(spark, "language"))
    if not machines:
        return model
    sample = spark.sparkContext.broadcast((x, members))

    def fitted(batches):
        x, members = sample.value
        for batch in batches:
            for node, pair, a, b in zip(*(c.to_pylist() for c in batch.columns)):
                first, second = members[node][a], members[node][b]
                w = fit_svm([x[i] for i in (*first, *second)], np.repeat([1.0, -1.0], [len(first), len(second)]))
                yield pa.RecordBatch.from_arrays([pa.array([node]), pa.array([pair]), pa.array([w.tobytes()])],
                                                 names=["node", "pair", "weights"])

    tasks = spark.createDataFrame(machines, "node long, pair long, a long, b long")
    # A node's machines in a few files, the work spread.
    tasks = tasks.repartition(min(len(machines), max(8, len(machines) // 60)), "node", F.floor(F.col("pair") / 8))
    tasks.mapInArrow(fitted, "node long, pair long, weights binary").write.partitionBy("node").parquet(model.folder)
    sample.unpersist()
    return model


def predict(model: LanguageModel, text: str = "text") -> Column:
    """struct(lang_pred, score) of a text column. Null text or text without a letter: (`und`, 0)."""
    @F.pandas_udf("struct<lang_pred: string, score: double>")
    def run(body: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(model.predict_all(body.tolist()), columns=["lang_pred", "score"])
    return run(F.col(text))


def identify(docs: DataFrame, held_out: Column) -> tuple[DataFrame, LanguageModel]:
    """Predictions for all of ``docs`` by a model learned from the rows not ``held_out``:
    (doc_id, held_out, lang_pred, score). Repeated rows are scored each; an empty table gives no rows."""
    narrow = docs.select("doc_id", "text", "lang")
    model = fit(narrow.filter(~held_out))
    out = narrow.select("doc_id", held_out.alias("held_out"), predict(model).alias("__p"))
    return out.select("doc_id", "held_out", "__p.lang_pred", "__p.score"), model


@query("op8_language_id")
def op8_language_id(spark, sf_dir):
    return identify(read(spark, sf_dir, "documents"), crc_mod("doc_id", 4) == 2)[0]
