"""Language identification in two steps: the family first, then the language within it.

Features are hashed byte n-grams (1 to 3 bytes) of the whole text with ASCII
capitals lower-cased and ASCII non-letters made blanks, weighted by the square
root of their share.  One linear support vector machine a family (one against
the rest) picks the family; within a family, one machine for each pair of its
languages votes.  Machines are trained here by dual coordinate descent.

Training reads at most ``SAMPLE_ROWS`` labelled documents, the same number for
each language (those of the smallest id hash), their whole texts.  Of more
than ``LANGUAGES`` labels the most frequent are learned, ties by name, so that
a noisy label column bounds neither sample nor model from above.

Defined cases: a text that is null, empty or without a letter is ``und`` with
score 0, as is every text if nothing is labelled; rows with a null id are
predicted but never learned from; repeated rows are answered alike, each, and
learned from once; of different texts under one id the smallest is learned
from; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cumulus.llm.common import carried

# fixed values: languages by family; a language that is not listed is a family of its own
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af", "fy", "lb", "yi"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl", "oc", "la"),
    "slavic": ("ru", "uk", "be", "pl", "cs", "sk", "bg", "mk", "sr", "hr", "bs", "sl"),
    "baltic": ("lt", "lv"), "uralic": ("fi", "et", "hu"), "celtic": ("ga", "cy", "gd", "br"),
    "turkic": ("tr", "az", "kk", "uz", "ky", "tt"), "iranian": ("fa", "ku", "ps", "tg"),
    "indic": ("hi", "ur", "bn", "mr", "ne", "gu", "pa"), "semitic": ("ar", "he", "mt", "am"),
    "malayic": ("id", "ms", "jv", "su"),
}
SAMPLE_ROWS = 1200
LANGUAGES = 64
RANK_PARTS = 64
DIMS = 1 << 12
CHUNK = 1 << 20
UNKNOWN = "und"
EPOCHS = 30
_FOLD = bytes(b if b > 127 or chr(b).islower() else ord(chr(b).lower()) if chr(b).isupper() else 32 for b in range(256))


def family_of(lang: str) -> str:
    return next((f for f, members in FAMILIES.items() if lang in members), lang)


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def features(text: str) -> np.ndarray:
    """Weighted hashed n-grams, unit length; chunk by chunk, so that a very long text needs no more memory."""
    raw = text.encode().translate(_FOLD)
    counts = np.zeros(DIMS)
    for at in range(0, len(raw), CHUNK):
        b = np.frombuffer(raw, np.uint8, min(len(raw) - at, CHUNK + 2), at).astype(np.uint32)
        gram = np.zeros(len(b), np.uint32)
        for n in range(1, 4):
            m = len(b) - n + 1
            if m < 1:
                break
            gram = (gram[:m] << np.uint32(8)) | b[n - 1:]
            m = min(m, CHUNK)  # grams that start in the next chunk are counted there
            slot = ((gram[:m] + np.uint32(n << 24)) * np.uint32(2654435761)) >> np.uint32(20)
            counts += np.bincount(slot, minlength=DIMS)
    norm = np.sqrt(counts.sum())
    return np.sqrt(counts) / norm if norm else counts


def train_svm(x: np.ndarray, y: np.ndarray, c: float = 10.0, epochs: int = EPOCHS) -> np.ndarray:
    """Weights (the last one the bias) of a linear machine with squared hinge loss, by dual coordinate descent."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w, alpha = np.zeros(x.shape[1]), np.zeros(len(x))
    diag = (x * x).sum(axis=1) + 1 / (2 * c)
    rng = np.random.default_rng(5)
    for _ in range(epochs):
        for i in rng.permutation(len(x)):
            new = max(0.0, alpha[i] - (y[i] * (x[i] @ w) - 1 + alpha[i] / (2 * c)) / diag[i])
            if new != alpha[i]:
                w += (new - alpha[i]) * y[i] * x[i]
                alpha[i] = new
    return w


def _squash(margin):
    return 1 / (1 + np.exp(-4 * np.clip(margin, -50, 50)))


class LanguageModel:
    def __init__(self, x: np.ndarray, langs: list[str]):
        self.langs = sorted(set(langs))
        of = np.array(langs)
        fam = np.array([family_of(lang) for lang in langs])
        self.families = sorted(set(fam.tolist()))
        self.family_w = np.stack([train_svm(x, np.where(fam == f, 1, -1)) if len(self.families) > 1
                                  else np.zeros(DIMS + 1) for f in self.families]) if len(langs) else None
        self.members = {f: [lang for lang in self.langs if family_of(lang) == f] for f in self.families}
        self.pairs = {}
        for members in self.members.values():
            for i, a in enumerate(members):
                for b in members[i + 1:]:
                    rows = (of == a) | (of == b)
                    self.pairs[a, b] = train_svm(x[rows], np.where(of[rows] == a, 1, -1))

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.langs or not has_letter(text):
            return UNKNOWN, 0.0
        x = np.append(features(text), 1.0)
        chance = _squash(self.family_w @ x)
        best = int(np.argmax(chance))
        members = self.members[self.families[best]]
        score = float(chance[best] / chance.sum()) if len(chance) > 1 else 1.0
        if len(members) == 1:
            return members[0], score
        votes = dict.fromkeys(members, 0.0)
        wins = dict.fromkeys(members, 0)
        for i, a in enumerate(members):
            for b in members[i + 1:]:
                p = float(_squash(self.pairs[a, b] @ x))
                votes[a] += p
                votes[b] += 1 - p
                wins[a if p >= 0.5 else b] += 1
        lang = max(members, key=lambda m: (wins[m], votes[m]))
        return lang, score * votes[lang] / (len(members) - 1)


def held_out(id_col: Column) -> Column:
    """Documents that are never learned from: crc32 of the id as text is divisible by 5."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _featured(batches):
    for b in batches:
        rows = [(i, lang, features(t).astype(np.float32).tobytes()) for i, lang, t in zip(
            *(b.column(c).to_pylist() for c in ("id", "lang", "text")), strict=True) if t and has_letter(t)]
        ids, langs, xs = zip(*rows, strict=True) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(langs, pa.string()),
                                          pa.array(xs, pa.binary())], ["id", "lang", "x"])


def fit(docs: DataFrame, learn: Column, id_col="doc_id", text_col="text", lang_col="lang",
        sample_rows: int = SAMPLE_ROWS, languages: int = LANGUAGES) -> LanguageModel:
    """Train on at most ``sample_rows`` documents where ``learn`` (a condition on ``id``) holds, of at most
    ``languages`` labels."""
    named = docs.select(F.col(id_col).cast("long").alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    able = named.select("id", "lang").where(F.col("id").isNotNull() & F.col("lang").isNotNull() & learn)
    often = able.groupBy("lang").agg(F.count(F.lit(1)).alias("c")).orderBy(F.desc("c"), "lang").limit(languages).collect()
    if not often:
        return LanguageModel(np.empty((0, DIMS)), [])
    known = F.col("lang").isin([r["lang"] for r in often])
    able = able.where(known)
    # ranked within groups of input partitions first: each partition ships at most ``each`` rows a language,
    # and the last ranking sees at most RANK_PARTS * each of them, however many rows the language has
    each = max(1, sample_rows // len(often))
    able = able.select("*", F.xxhash64("id").alias("h"), (F.spark_partition_id() % RANK_PARTS).alias("part"))
    for keys in (["lang", "part"], ["lang"]):
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy("h", "id"))
        able = able.withColumn("r", rank).where(F.col("r") <= each)
    chosen = able.select("id").distinct()
    # at most sample_rows ids, so the broadcast is bounded
    texts = (named.join(F.broadcast(chosen), "id", "left_semi").where(known & F.col("text").isNotNull())
             .groupBy("id").agg(F.min(F.struct("text", "lang")).alias("of")).select("id", "of.lang", "of.text"))
    sample = texts.mapInArrow(_featured, "id long, lang string, x binary").orderBy("id").collect()
    x = np.array([np.frombuffer(r["x"], np.float32) for r in sample], float).reshape(len(sample), DIMS)
    return LanguageModel(x, [r["lang"] for r in sample])


def predict(docs: DataFrame, model: LanguageModel, text_col="text", keep_text=False) -> DataFrame:
    """Columns of ``docs`` (the text only if ``keep_text``), and lang_pred, score (replaced if they exist)."""
    keep = carried(docs, ["lang_pred", "score"] + ([] if keep_text else [text_col]))
    kept = text_col in keep and dict(docs.dtypes)[text_col] == "string"  # then it is sent to Python once
    rows = docs.select(F.struct(*[F.col(c) for c in keep] or [F.lit(0).alias("_")]).alias("doc"),
                       *[] if kept else [F.col(text_col).cast("string").alias("text")])
    shared = docs.sparkSession.sparkContext.broadcast(model)  # size: (families + pairs) * DIMS weights

    def run(batches):
        own = shared.value
        for b in batches:
            texts = b.column("doc").field(text_col) if kept else b.column("text")
            found = [own.predict(t.as_py()) for t in texts]
            langs, scores = zip(*found, strict=True) if found else ((), ())
            yield pa.RecordBatch.from_arrays([b.column("doc"), pa.array(langs, pa.string()),
                                              pa.array(scores, pa.float64())], ["doc", "lang_pred", "score"])

    kind = rows.schema["doc"].dataType.simpleString()
    got = rows.mapInArrow(run, f"doc {kind}, lang_pred string, score double")
    return got.select(*[F.col("doc")[c].alias(c) for c in keep], "lang_pred", "score")
