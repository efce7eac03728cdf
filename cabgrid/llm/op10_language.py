"""Language ID by string kernels (operator 10).

Kernel of two texts: how many character n-grams (of 1 to 4 UTF-8 bytes, A-Z
lower-cased) both hold, presence only, over the geometric mean of their
distinct n-gram counts (blended spectrum). Nyström features from a bounded set
of landmark texts, one-versus-rest kernel ridge regression on a bounded
labelled sample; a batch of texts is scored by two matrix products (its presence
matrix by the landmarks', in blocks, then the kernel by the regression weights).

What bounds the fit (documented parameters; everything else covers all rows):
LANDMARKS and SAMPLE rows for each label, chosen by a keyed hash of the id among
its texts with a letter; of more than FULL_LANGUAGES labels all are learnt, from
fewer rows each (``shares``). A text of more than SAMPLE_CHARS code points is
learnt by that many from its first letter on. Prediction reads whole texts,
every n-gram of them.

Edge cases: a text that is null or holds no letter is ``und`` with score 0; an
empty training set makes every row ``und`` (``keep_identified`` then drops only
texts that are null or hold no letter); null languages are never learnt;
repeated rows get the same answer; columns beyond doc_id, text and lang are
ignored; predictions use the text alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table
from .textscan import CHUNK, LOWER, bytes_of, slices

LANDMARKS = 16
SAMPLE = 300
SAMPLE_CHARS = 20_000
FULL_LANGUAGES = 64
LEAST_ROWS = 8
OVERSAMPLE = 4
RIDGE = 1e-3
GRAMS = 4
SLOTS = 1 << 22
TEXTS, COLUMNS = 256, 4096
UND = "und"
#: What ``keep_identified`` takes: 0.5 is a tie of the two best languages.
LEAST_SCORE = 0.6
LETTER = regex.compile(r"\p{L}")


def held_out(doc_id: Column) -> Column:
    """crc32 of the id's decimal text, modulo 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def gram_slots(data: np.ndarray, n: int) -> np.ndarray:
    """Slot (of SLOTS) of the n-gram at each position; n-grams of one or two
    bytes have a slot each, longer ones share slots by a multiplicative hash."""
    code = data[:len(data) - n + 1].astype(np.uint32)
    for i in range(1, n):
        code = (code << np.uint32(8)) | data[i:len(data) - n + 1 + i]
    if n <= 2:
        return code + np.uint32(256 * (n - 1))
    hashed = (code * np.uint32(2654435761) + np.uint32(n * 40503)) * np.uint32(2246822519)
    return (hashed >> np.uint32(10)) % np.uint32(SLOTS - 66_000) + np.uint32(66_000)


def distinct_slots(data: np.ndarray) -> np.ndarray:
    """The sorted distinct slots of one text's bytes, whole, by windows."""
    found = np.zeros(0, np.uint32)
    for a in range(0, len(data), CHUNK):
        part = data[a:a + CHUNK + GRAMS - 1]
        some = np.unique(np.concatenate([gram_slots(part, n)[:CHUNK] for n in range(1, GRAMS + 1) if len(part) >= n]))
        found = np.union1d(found, some) if len(found) else some
    return found


class Model:
    """Landmark n-grams, kernel-to-score weights and the languages."""

    def __init__(self, texts: list[str], langs: list[str], landmarks: list[bool]):
        sets = [distinct_slots(LOWER[np.frombuffer(t.encode(), np.uint8)]) for t in texts]
        marks = [s for s, m in zip(sets, landmarks) if m]
        self.langs = sorted(set(langs))
        self.slots = np.unique(np.concatenate(marks)) if marks else np.zeros(0, np.uint32)
        # one row per n-gram of any landmark, one column per landmark: presence / sqrt(size)
        self.marks = np.zeros((len(self.slots), len(marks)), np.float32)
        for j, s in enumerate(marks):
            self.marks[np.searchsorted(self.slots, s), j] = 1 / np.sqrt(len(s))
        k = self._kernel(sets).astype(np.float64)
        kmm = k[np.array(landmarks, bool)]
        value, vector = np.linalg.eigh((kmm + kmm.T) / 2)
        keep = value > 1e-9 * value.max()
        self.feature = vector[:, keep] / np.sqrt(value[keep])
        phi = k @ self.feature
        target = np.array([[1.0 if x == c else -1.0 for c in self.langs] for x in langs])
        self.mean, self.shift = phi.mean(0), target.mean(0)
        centred = phi - self.mean
        gram = centred.T @ centred + RIDGE * len(langs) * np.eye(phi.shape[1])
        weights = np.linalg.solve(gram, centred.T @ (target - self.shift))
        self.weights = (self.feature @ weights).astype(np.float32)
        self.bias = (self.shift - self.mean @ weights).astype(np.float32)

    def _kernel(self, sets: list[np.ndarray]) -> np.ndarray:
        known = [np.flatnonzero(np.isin(self.slots, s, assume_unique=True)) for s in sets]
        return presence_product(known, [len(s) for s in sets], self.marks)


def presence_product(known: list[np.ndarray], sizes: list[int], marks: np.ndarray) -> np.ndarray:
    """Kernel of texts with landmarks: the texts' presence matrix (row i: ones
    at ``known[i]``, over the root of ``sizes[i]``) times ``marks``, by blocks
    of TEXTS rows and COLUMNS n-grams, so memory does not grow with a text."""
    out = np.zeros((len(known), marks.shape[1]), np.float32)
    for a in range(0, len(known), TEXTS):
        part = known[a:a + TEXTS]
        at = np.concatenate(part)
        text = np.repeat(np.arange(len(part)), [len(x) for x in part])
        order = np.argsort(at, kind="stable")
        at, text = at[order], text[order]
        for start in range(0, len(marks), COLUMNS):
            cut = slice(*np.searchsorted(at, [start, start + COLUMNS]))
            if cut.stop > cut.start:
                block = marks[start:start + COLUMNS]
                presence = np.zeros((len(part), len(block)), np.float32)
                presence[text[cut], at[cut] - start] = 1
                out[a:a + TEXTS] += presence @ block
    return out / np.sqrt(np.maximum(1, np.array(sizes, np.float32)))[:, None]


class Scorer:
    """Scores batches of Arrow strings; holds a slot table (built per task)."""

    def __init__(self, model: Model):
        self.model = model
        self.row = np.full(SLOTS, len(model.slots), np.int32)
        self.row[model.slots] = np.arange(len(model.slots), dtype=np.int32)

    def kernel(self, column: pa.Array) -> np.ndarray:
        data, offsets = bytes_of(column)
        known, sizes = [], []
        for i in range(len(column)):
            mine = distinct_slots(LOWER[data[offsets[i]:offsets[i + 1]]])
            rows = self.row[mine]
            known.append(rows[rows < len(self.model.slots)])
            sizes.append(len(mine))
        return presence_product(known, sizes, self.model.marks)

    def __call__(self, column: pa.Array) -> tuple[list[str], np.ndarray]:
        values = self.kernel(column) @ self.model.weights + self.model.bias
        best = values.argmax(1)
        top = values[np.arange(len(best)), best]
        rest = np.where(np.arange(values.shape[1]) == best[:, None], -np.inf, values).max(1, initial=-1.0)
        score = 1 / (1 + np.exp(-4.0 * (top - np.maximum(rest, -1.0)).astype(np.float64)))
        return [self.model.langs[i] for i in best], score


def shares(languages: int, per_language: int, landmarks: int) -> tuple[int, int]:
    """Rows and landmarks of each language: as given for up to FULL_LANGUAGES
    of them; of more, as many as keep the sample's size, but LEAST_ROWS rows
    and one landmark at least."""
    if languages <= FULL_LANGUAGES:
        return per_language, landmarks
    fewer = lambda n, least: min(n, max(least, n * FULL_LANGUAGES // languages))
    return fewer(per_language, LEAST_ROWS), fewer(landmarks, 1)


def training_rows(docs: DataFrame, per_language: int = SAMPLE, max_chars: int = SAMPLE_CHARS) -> DataFrame:
    """The bounded labelled sample (lang, doc_id, text, n): of each language
    the ``per_language`` (see ``shares``) rows first by a keyed hash of the id,
    none held out. The counts (one row per language on the driver) of the rows
    that can be taken give hash thresholds that about OVERSAMPLE times as many
    rows pass in the scan; only those are ranked."""
    labelled = docs.filter(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    counts = labelled.groupBy("lang").agg(F.count("*").alias("rows")).collect()
    per_language, _ = shares(len(counts), per_language, LANDMARKS)
    limits = docs.sparkSession.createDataFrame(
        [(r["lang"], OVERSAMPLE * per_language / r["rows"]) for r in counts], "lang string, least double")
    h = F.xxhash64(F.lit("lang"), F.col("doc_id"))
    excerpt = F.when(F.char_length("text") <= max_chars, F.col("text")).otherwise(
        F.substring(F.regexp_extract("text", r"(?s)\p{L}.*+", 0), 1, max_chars))
    some = (labelled.join(F.broadcast(limits), "lang").filter((F.shiftrightunsigned(h, 11) / float(1 << 53)) < F.col("least"))
            .select("lang", F.col("doc_id").cast("long").alias("doc_id"), h.alias("h"), excerpt.alias("text")))
    w = Window.partitionBy("lang").orderBy("h", "doc_id", "text")
    return (some.withColumn("n", F.row_number().over(w)).filter(F.col("n") <= per_language)
            .select("lang", "doc_id", "text", "n"))


def fit(docs: DataFrame, per_language: int = SAMPLE, landmarks: int = LANDMARKS) -> Model | None:
    """Fitted on the driver: the sample has at most per_language *
    FULL_LANGUAGES rows (or LEAST_ROWS for each language, if that is more) of
    at most SAMPLE_CHARS code points."""
    rows = training_rows(docs, per_language).collect()
    if not rows:
        return None
    rows.sort(key=lambda r: (r["lang"], r["n"]))
    _, landmarks = shares(len({r["lang"] for r in rows}), per_language, landmarks)
    return Model([r["text"] for r in rows], [r["lang"] for r in rows], [r["n"] <= landmarks for r in rows])


def with_letter(column: pa.Array) -> np.ndarray:
    """Whether each text of a batch holds a letter."""
    return np.array([bool(t) and LETTER.search(t) is not None for t in column.to_pylist()], bool)


def identify(column: pa.Array, scorer: Scorer | None) -> tuple[list[str], np.ndarray]:
    """Language and score of each text of a batch."""
    letters = with_letter(column)
    if scorer is None or not len(letters):
        return [UND] * len(letters), np.zeros(len(letters))
    langs, scores = scorer(column)
    return [x if ok else UND for x, ok in zip(langs, letters)], np.where(letters, scores, 0.0)


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, lang_pred, score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # size bounded by the sample

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value) if shared.value is not None else None
        for batch in slices(batches, 1):
            langs, scores = identify(batch.column(1), scorer)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                ["doc_id", "lang_pred", "score"])

    return (docs.select(F.col("doc_id").cast("long"), "text")
            .mapInArrow(run, "doc_id long, lang_pred string, score double"))


def keep_identified(docs: DataFrame, model: Model | None, languages: list[str] | None = None,
                    least_score: float = LEAST_SCORE) -> DataFrame:
    """The rows of ``docs`` whose text has a predicted language (one of
    ``languages``, if given) with a score of at least ``least_score``, in one
    pass. A null ``lang`` gets the prediction; the other columns stay. Without
    a model nothing can be told apart: then every text with a letter stays, as
    it is."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    text_at = docs.columns.index("text")
    lang_at = docs.columns.index("lang") if dict(docs.dtypes).get("lang") == "string" else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value) if shared.value is not None else None
        for batch in slices(batches, text_at):
            text = batch.column(text_at)
            if scorer is None:
                yield batch.filter(pa.array(with_letter(text), pa.bool_()))
                continue
            found, scores = identify(text, scorer)
            keep = [x != UND and s >= least_score and (languages is None or x in languages) for x, s in zip(found, scores)]
            if lang_at is not None:
                lang = batch.column(lang_at)
                said = pa.array([None if x == UND else x for x in found], lang.type)
                batch = batch.set_column(lang_at, batch.schema.field(lang_at), pc.coalesce(lang, said))
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = predict(docs, fit(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
