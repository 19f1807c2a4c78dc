"""Language of a text in two steps: the family, then the language within it.

Both steps are linear support vector machines between two classes each: one between every
two families, one between every two languages of a family.  A text is hashed counts of its
one to three byte sequences, lower-cased, square-rooted and scaled to length one; the whole
text counts.

The machines are fitted on a bounded sample: of each language the ``sample_per_language``
labelled documents whose id hashes lowest, outside the held-out fifth.  Each machine is
fitted in a task of its own on the sample of its own classes; the driver holds their weights
only, which are bounded by the number of languages.

Defined results: null texts and texts without a letter are ``und`` with score 0.  Documents
with a null id are not held out and not learned from.  Without a usable label every text is
``und``; with a single language every text with a letter is that language.  Repeated rows
give a row each; an empty table gives no rows.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmart.llm.common import each_batch, give_back, only
from starmart.session import stage

UNDETERMINED = "und"
SAMPLE_PER_LANGUAGE = 600  # labelled documents that are learned from, for each language
FEATURES = 1 << 12
EPOCHS = 12
REGULARISATION = 1e-4
#: Families of languages by ISO 639-1 code; a language that isn't here is a family of its own.
FAMILIES = {
    "germanic": "af da de en fy is lb nl no nb nn sv yi",
    "romance": "ca es fr gl it oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "uralic": "et fi hu",
    "indo-aryan": "bn gu hi mr ne pa si ur",
    "turkic": "az kk ky tk tr tt ug uz",
    "semitic": "am ar he mt",
}
_FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes.split()}
_LETTER = regex.compile(r"\p{L}")


def family(lang: str) -> str:
    return _FAMILY_OF.get(lang.split("-")[0].lower(), f"only {lang}")


def features(text: str) -> np.ndarray:
    """Unit vector of hashed one to three byte sequences."""
    raw = np.frombuffer(f" {text.lower()} ".encode("utf-8", "replace"), np.uint8).astype(np.uint32)
    pairs = (raw[:-1] << 8) | raw[1:]
    triples = (pairs[:-1] << 8) | raw[2:]
    counts = np.zeros(FEATURES, np.int64)
    for salt, grams in enumerate((raw, pairs, triples)):
        mixed = (grams + np.uint32(salt * 0x01000193)) * np.uint32(2654435769)
        counts += np.bincount(mixed >> np.uint32(20), minlength=FEATURES)
    x = np.sqrt(counts, dtype=np.float32)
    return x / np.linalg.norm(x)


def fit_machine(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights (last: bias) of a linear SVM by averaged stochastic subgradient steps; y is -1 or 1."""
    rng = np.random.default_rng(7)
    x = np.hstack([x, np.ones((len(x), 1), np.float32)])
    # Both classes weigh the same, however many documents each has.
    cost = np.where(y > 0, len(y) / (2 * max(1, (y > 0).sum())), len(y) / (2 * max(1, (y < 0).sum())))
    w, mean, step, block = np.zeros(x.shape[1]), np.zeros(x.shape[1]), 0, 16
    for _ in range(EPOCHS):
        for rows in np.array_split(rng.permutation(len(x)), max(1, len(x) // block)):
            step += 1
            rate = min(10.0, 1 / (REGULARISATION * (step + 100)))
            inside = (x[rows] @ w) * y[rows] < 1
            push = (x[rows][inside] * (y[rows] * cost[rows])[inside, None]).sum(0) / len(rows)
            w = (1 - rate * REGULARISATION) * w + rate * push
            mean += (w - mean) / step
    return mean


def _classifiers(langs: list[str]) -> list[tuple[str, list[str], list[str]]]:
    """(name, languages of the negative class, of the positive class): families first, then languages in a family."""
    families: dict[str, list[str]] = {}
    for lang in sorted(langs):
        families.setdefault(family(lang), []).append(lang)
    names = sorted(families)
    out = [("family", families[a], families[b]) for a, b in combinations(names, 2)]
    return out + [("language", [a], [b]) for name in names for a, b in combinations(families[name], 2)]


class LanguageModel:
    """Families, their languages, and the machine between any two of either."""

    def __init__(self, langs: list[str], weights: list[np.ndarray]):
        self.families: dict[str, list[str]] = {}
        for lang in sorted(langs):
            self.families.setdefault(family(lang), []).append(lang)
        self.names = sorted(self.families)
        self.machines = np.array(weights) if weights else np.zeros((0, FEATURES + 1))
        self.at = {}
        for k, (kind, negative, positive) in enumerate(_classifiers(langs)):
            self.at[(kind, negative[0], positive[0])] = k

    def _duel(self, kind: str, members: list[str], margins: np.ndarray) -> tuple[str, float]:
        """Most duels won, then the largest sum of margins; the score is the least certain duel of the winner."""
        if len(members) == 1:
            return members[0], 1.0
        wins = {m: [0, 0.0, np.inf] for m in members}
        for a, b in combinations(members, 2):
            margin = float(margins[self.at[(kind, a, b)]])
            for m, own in ((a, -margin), (b, margin)):
                wins[m] = [wins[m][0] + (own > 0), wins[m][1] + own, min(wins[m][2], own)]
        best = max(members, key=lambda m: (wins[m][0], wins[m][1]))
        return best, 1 / (1 + float(np.exp(-min(50.0, max(-50.0, 3 * wins[best][2])))))

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.names or not _LETTER.search(text):
            return UNDETERMINED, 0.0
        margins = self.machines[:, :-1] @ features(text) + self.machines[:, -1]
        heads = [self.families[name][0] for name in self.names]
        head, sure = self._duel("family", heads, margins)
        lang, surer = self._duel("language", self.families[family(head)], margins)
        return lang, sure * surer


def held_out(doc_id) -> F.Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, sample_per_language: int = SAMPLE_PER_LANGUAGE) -> LanguageModel:
    """Fit on ``docs(doc_id, text, lang)``: labelled documents outside the held-out fifth."""
    usable = docs.where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(docs["doc_id"])
    )
    # About twice the sample passes the hash test, so a task gets few documents of a frequent language.
    share = usable.groupBy("lang").agg((F.lit(2.0 * sample_per_language) / F.count(F.lit(1))).alias("share"))
    drawn = usable.join(F.broadcast(share), "lang").where(
        F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < F.col("share") * (1 << 30)
    )
    lowest = Window.partitionBy("lang").orderBy(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)), "doc_id", F.xxhash64("text"))
    sample = drawn.withColumn("nth", F.row_number().over(lowest)).where(F.col("nth") <= sample_per_language)
    sample = stage(sample.select("lang", "text"), "language-sample")
    langs = sorted(r["lang"] for r in sample.select("lang").distinct().collect())
    plan = _classifiers(langs)
    if not plan:
        return LanguageModel(langs, [])
    roles = [(k, lang, sign) for k, (_, a, b) in enumerate(plan) for sign, side in ((-1, a), (1, b)) for lang in side]
    spark = docs.sparkSession
    side = spark.createDataFrame(roles, "machine int, lang string, sign int")

    def train(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows[[bool(_LETTER.search(t)) for t in rows["text"]]].sort_values(["lang", "text"])
        x = np.stack([features(t) for t in rows["text"]]) if len(rows) else np.zeros((0, FEATURES), np.float32)
        weights = fit_machine(x, rows["sign"].to_numpy())
        del x
        give_back()
        return pd.DataFrame({"machine": rows["machine"].iloc[:1] if len(rows) else [], "weights": [weights.tolist()] * (len(rows) > 0)})

    fitted = sample.join(F.broadcast(side), "lang").groupBy("machine").applyInPandas(train, "machine int, weights array<double>")
    weights = {r["machine"]: np.array(r["weights"]) for r in fitted.collect()}
    return LanguageModel(langs, [weights.get(k, np.zeros(FEATURES + 1)) for k in range(len(plan))])


def predict(
    docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every whole text."""
    source = only(docs, doc_id=id_col, text=text_col)
    source = source.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [model.predict(t) for t in batch.column(2).to_pylist()]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
            names=["doc_id", "held_out", "lang_pred", "score"],
        )

    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(each_batch(make), f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    return predict(docs, fit(only(docs, doc_id=id_col, text=text_col, lang=lang_col)), id_col, text_col)


def keep_identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The documents whose language can be told; a missing ``lang`` becomes the predicted one.

    Documents without a letter go.  Where no label can be learned from, languages stay unknown
    and every document with a letter is kept.
    """
    model = fit(only(docs, doc_id=id_col, text=text_col, lang=lang_col))

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = batch.column(batch.schema.get_field_index(text_col)).to_pylist()
        if not model.names:
            return batch.filter(pa.array([bool(t and _LETTER.search(t)) for t in found], pa.bool_()))
        told = [model.predict(t)[0] for t in found]
        at = batch.schema.get_field_index(lang_col)
        known = pc.coalesce(batch.column(at), pa.array(told, pa.string()).cast(batch.schema.field(at).type))
        return batch.set_column(at, batch.schema.field(at), known).filter(pa.array([x != UNDETERMINED for x in told], pa.bool_()))

    return docs.mapInArrow(each_batch(make, give_back), docs.schema)
