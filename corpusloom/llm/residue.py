"""Template residue, filler, error pages and script notices, by a linear classifier on hashed n-grams."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructType

from corpusloom.llm.shapes import FEATURES, Parts, parts_of, pieces, sparse_vectors

#: The most documents whose parts the classifier is trained on, of how many of them one is taken whole, and the score from which a part is faulty (see ``residue_on_unseen_kinds``).
TRAINED_ON, CLEAN, THRESHOLD = 20_000, 4, 0.5

# Weak labels by kind.  Signs of positions that were never filled in, and usual words of filler, errors and notices, in
# small letters without marks.  They are used in training only.
KINDS = {
    "braces": (r"\{\{[^{}\n]{1,60}\}\}", r"[$#@%]\{[^{}\n]{1,60}\}", r"\{[a-z_][^{}\n:\"]{0,60}\}", r"\{\d\}", r"\{%[^%\n]{1,60}%\}"),
    "angles": (r"<%[^%\n]{1,60}%>", r"<<[^<>\n]{1,60}>>", r"<[a-z_][a-z\d_ .-]{0,60}>", r"\x01[^\x02\n]{1,60}\x02"),
    "brackets": (r"\[\[[^\[\]\n]{1,60}\]\]", r"\[(?!\s*(?:degisik|ek|mulga|iptal|amended|repealed|sic)\b)[a-z_][^\[\]\n]{0,60}\]", r"\[\s*\.\.\.[^\[\]\n]{1,60}\]"),
    "pairs": (r"@@[^@\n]{1,60}@@", r"##[^#\n]{1,60}##", r"__[a-z][a-z\d_ -]{0,60}__", r"/\*[^*\n]{1,60}\*/", r"\|[a-z][a-z\d_ -]{0,40}\|", r"%[a-z][a-z\d_ -]{0,40}%", r"\$[a-z][a-z\d_ -]{0,40}\$", r"\$\d\b"),
    "requests": (r"\([^()\n]{0,60}(?:buraya|lutfen)[^()\n]{0,60}\)", r"\([^()\n]{1,60}(?:doldurulacak|yazilacak|eklenecek|girilecek|giriniz|seciniz|belirtin|yaziniz)[a-z]*\)"),
    "empty values": (r"\b(?:undefined|null|nan|nil|invalid date)\b(?![\"'=:])", r"\[object object\]", r"(?<!\S)%[sd]\b", r"(?<=\s)none(?=[\s.,])", r"#(?:n/a|ref!|yok|deger!|ad\?|value!|name\?)"),
    "blanks": (r"_{3,}", r"(?:_ ){3,}", r"\(\s{2,}\)", r"\[\s{2,}\]", r"\?{4,}", r"#{4,}", r"(?<![a-z])x{4,}(?![a-z])", r"\bxx\.xx\.", r"\b(?:gg\.aa|dd\.mm)\.", r"yyyy/n", r"__/__", r"-{5,}", r"\.{6,}"),
    "status": (r"\b(?:http|status|error|hata|fehler)\W{0,3}(?:status |kodu:? )?[45]\d\d\b", r"\b[45]\d\d\W{1,3}(?:not found|bad|internal|forbidden|service|gateway|unauthorized|too many)", r"\b(?:bad gateway|gateway timeout|unauthorized|service unavailable|access ?denied)\b"),
    "program errors": (r"exception\b", r"\b[a-z]+error:", r"\b(?:fatal|server|internal) error\b", r"traceback", r"stack trace", r"\bora-\d{4,5}", r"sqlstate", r"^\s*at [\w.$]+\(", r"^\s*warning: ", r"\bon line \d"),
    "failures": (r"(?:sunucu|sistem|veritabani) hatasi", r"zaman asimina ugradi", r"hata olustu", r"bulunamadi", r"ulasilamadi", r"yuklenemedi", r"baglanti (?:kesildi|koptu)", r"yetkiniz yok", r"erisim engellendi", r"oturum\w* (?:sona erdi|doldu|\w+ doldu)", r"(?:yeniden|tekrar) deneyin", r"try again", r"\b(?:could|can) ?not be \w+ed\b", r"failed to be", r"\bnot found\b", r"giris yapmaniz", r"cok fazla (?:sorgu|istek)", r"beklenmedik bir (?:sorun|hata)", r"hata kodu: ?\w", r"(?:silinmis|tasinmis|kaldirilmis|kapatilmis) (?:olabilir|gorunuyor)", r"gecici olarak (?:kapali|hizmet)", r"yanit (?:suresi doldu|vermiyor)"),
    "scripts": (r"java ?script", r"\bscripts?\b", r"scripting", r"active content", r"betik", r"komut dosyalari", r"\bjs\b", r"cerezleri etkinlestir(?:in|ip)", r"enable cookies", r"icerige izin ver", r"etkin icerik", r"tarayicini", r"your browser", r"robot olmadiginizi"),
    "filler": (r"lorem ipsum", r"(?:\b(?:lorem|ipsum|dolor|amet)\b.*){2}", r"\b([a-z]+)(?: \1){2,}", r"asdf|qwer|zxcv|asdasd|sdfsdf", r"(?:deneme|ornek|taslak|gecici) (?:metin|metni|yazisi|icerik|paragraf)", r"(?:buraya|bu alana|bu bolume|satira) .{0,40}(?:girilecek|yazilacak|eklenecek|gelecek|yerlestirilecek)", r"daha sonra eklenecek", r"yer tutucu"),
}
# What follows a mentioned sign or phrase, and how a sentence tells of one.
MENTIONED = r"^[^.;\n]{0,12}\b(?:ibaresi|iletisi|uyarisi|yazisi|kutusu|bolumu|degeri|ciktisi|numarali|biciminde)"
TOLD = r"(?:mis|mus)tir|\b(?:ibaresi|iletisi|uyarisi|yazisi|uyarinca)\b|yazdigini|belirdigini|yazisinin|ibaresinin"
UNFILLED = ("braces", "angles", "brackets", "pairs", "requests", "empty values", "blanks")
QUOTED = r"\"[^\"\n]{1,200}\""


@cache
def _rules(left_out: tuple[str, ...]) -> tuple[list[re.Pattern], list[re.Pattern]]:
    """Patterns of unfilled positions and of phrases, of all kinds but those left out."""

    def of(names: Sequence[str]) -> list[re.Pattern]:
        chosen = [p for n in names if n not in left_out for p in KINDS[n]]
        # A back reference counts groups over the whole pattern, so its pattern stays alone.
        alone = [p for p in chosen if "\\1" in p]
        joined = "|".join(f"(?:{p})" for p in chosen if p not in alone)
        return [re.compile(p.encode()) for p in [joined, *alone] if p]

    return of(UNFILLED), of([n for n in KINDS if n not in UNFILLED])


_MENTIONED, _TOLD, _QUOTED = (re.compile(p.encode()) for p in (MENTIONED, TOLD, QUOTED))


def weak_label(part: bytes, left_out: tuple[str, ...] = ()) -> bool:
    """Whether a folded part shows one of the signs, outside of quotation marks and not as something the sentence tells of."""
    unfilled, phrases = _rules(left_out)
    bare = _QUOTED.sub(b' "" ', part)
    if any(not _MENTIONED.search(bare[m.end() : m.end() + 40]) for p in unfilled for m in p.finditer(bare)):
        return True
    return any(p.search(bare) for p in phrases) and not _TOLD.search(bare)


def _shows_sign(part: bytes) -> bool:
    return any(p.search(part) for rules in _rules(()) for p in rules)


def _spread(rows: DataFrame) -> DataFrame:
    """Much work for each row: a table of few files is spread over all cores."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores, "text") if rows.rdd.getNumPartitions() < cores else rows


def _texts(rows: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return rows.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text")).filter("text is not null")


@dataclass(frozen=True)
class ResidueModel:
    """Weights of the features, the bias, and the score from which a part is faulty."""

    weights: np.ndarray
    bias: float
    threshold: float

    def part_scores(self, parts: Parts) -> np.ndarray:
        total = np.bincount(parts.owner, self.weights[parts.index], minlength=len(parts.text)) + self.bias
        return 1 / (1 + np.exp(-total))

    def scored(self, rows: DataFrame, id_col: str, text_col: str, left_out: tuple[str, ...] | None = None) -> DataFrame:
        """(doc, score): the score of each text's worst part, without a shuffle.  With ``left_out`` also ``weak`` and ``held``: whether a
        part has a weak label of any kind, and whether one has a label of a kind that is left out."""
        texts = _spread(_texts(rows, id_col, text_col))
        model = rows.sparkSession.sparkContext.broadcast(self)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                worst, weak, held = np.zeros(batch.num_rows), np.zeros(batch.num_rows, bool), np.zeros(batch.num_rows, bool)
                for i, data, offsets in pieces(batch.column("text")):
                    parts = parts_of(data, offsets)
                    np.maximum.at(worst, i + parts.text, model.value.part_scores(parts))
                    if left_out is not None:
                        labels = np.array([[weak_label(parts.folded[a:b]), weak_label(parts.folded[a:b], left_out)] for a, b in zip(parts.start, parts.end)], bool).reshape(-1, 2)
                        weak[i + parts.text[labels[:, 0]]] = True
                        held[i + parts.text[labels[:, 0] & ~labels[:, 1]]] = True
                columns = [batch.column("doc"), pa.array(worst)] + [pa.array(weak), pa.array(held)] * (left_out is not None)
                yield pa.RecordBatch.from_arrays(columns, ["doc", "score", "weak", "held"][: len(columns)])

        kind = dict(texts.dtypes)["doc"]
        return texts.mapInArrow(run, f"doc {kind}, score double" + (", weak boolean, held boolean" if left_out is not None else ""))

    def faulty(self, rows: DataFrame, id_col: str, text_col: str) -> DataFrame:
        """(doc, score) of the texts with a part whose score reaches ``threshold``, each id once."""
        return self.scored(rows, id_col, text_col).filter(F.col("score") >= self.threshold).groupBy("doc").agg(F.max("score").alias("score"))


def _vectors(parts: Parts, chosen: np.ndarray) -> pa.Array:
    """The features of the chosen parts as Spark's sparse vectors, counted."""
    number = np.full(len(parts.text), -1)
    number[chosen] = np.arange(len(chosen))
    owner = number[parts.owner]
    return sparse_vectors(owner[owner >= 0], parts.index[owner >= 0], len(chosen), FEATURES)


def train_residue(rows: DataFrame, id_col: str, text_col: str, trained_on: int = TRAINED_ON, threshold: float = THRESHOLD, left_out: tuple[str, ...] = ()) -> ResidueModel | None:
    """A regularised logistic classifier of parts, from weak labels.

    Trained on at most about ``trained_on`` documents, chosen by the hash of their id: on all parts of one in CLEAN of them, and of the
    others on those that show a sign, be it labelled or told of, which weigh ten times as much.  Parts that only a kind in ``left_out`` would label are not
    trained on at all.  None where the sample has no part of one of the two classes.
    """
    texts = _texts(rows, id_col, text_col)
    step = max(1, -(-rows.count() // trained_on))
    draw = F.pmod(F.xxhash64(F.col("doc").cast("string"), F.lit("residue")), F.lit(step * CLEAN))
    sample = _spread(texts.withColumn("draw", draw).filter(F.col("draw") % step == 0).select("text", (F.col("draw") == 0).alias("whole")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = np.asarray(batch.column("whole"))
            for i, data, offsets in pieces(batch.column("text")):
                parts = parts_of(data, offsets)
                if not len(parts.text):
                    continue
                each = [parts.folded[a:b] for a, b in zip(parts.start, parts.end)]
                sign = np.array([_shows_sign(x) for x in each])
                label = np.array([s and weak_label(x, left_out) for s, x in zip(sign, each)])
                chosen = label | whole[i + parts.text] | sign
                if left_out:
                    chosen &= label | ~np.array([s and weak_label(x) for s, x in zip(sign, each)])
                chosen = np.flatnonzero(chosen)
                yield pa.RecordBatch.from_arrays([pa.array(label[chosen].astype(np.float64)), pa.array(1 + 9.0 * sign[chosen]), _vectors(parts, chosen)], ["label", "weight", "features"])

    schema = StructType().add("label", DoubleType()).add("weight", DoubleType()).add("features", VectorUDT())
    data = sample.mapInArrow(run, schema).persist()
    learner = LogisticRegression(weightCol="weight", maxIter=30, regParam=5e-6, elasticNetParam=0.0, standardization=False, aggregationDepth=2)
    try:
        if len(data.select("label").distinct().collect()) < 2:
            return None
        fitted = learner.fit(data)
        return ResidueModel(fitted.coefficients.toArray().astype(np.float32), float(fitted.intercept), threshold)
    finally:
        data.unpersist()


def find_residue(rows: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, score): texts in which somewhere a position was never filled in, or filler, an error message
    or a notice that scripts or another browser are needed stands in place of content.

    Weak labels teach a linear classifier of sentences and lines, which alone decides; see ``train_residue``.
    Null and blank texts are no case, very long ones are read to their end, equal texts get equal scores, an id comes once.
    Where the table has no weak label at all, or nothing else, the result is empty.
    """
    model = train_residue(rows, id_col, text_col)
    if model is None:
        return rows.select(F.col(id_col).alias("doc"), F.lit(0.0).alias("score")).limit(0)
    return model.faulty(rows, id_col, text_col)


_REPORT = "n_docs bigint, n_weak bigint, n_found bigint, n_both bigint, precision double, recall double"


def _report(scored: DataFrame, threshold: float, *groups: str) -> DataFrame:
    found = F.col("score") >= threshold
    out = scored.groupBy(*groups).agg(F.count("*").alias("n_docs"), F.count_if("weak").alias("n_weak"), F.count_if(found).alias("n_found"), F.count_if(F.col("weak") & found).alias("n_both"))
    return out.withColumn("precision", F.round(F.try_divide("n_both", "n_found"), 6)).withColumn("recall", F.round(F.try_divide("n_both", "n_weak"), 6))


def residue_on_unseen_hosts(rows: DataFrame, id_col: str, text_col: str, host: Column, folds: int = 5) -> DataFrame:
    """One row: n_docs, n_weak, n_found, n_both, precision and recall against the weak labels, on the documents of
    one in ``folds`` hosts (by the hash of their name; no host is a host too), by a classifier that was trained on the others.

    No rows where the training part has no weak label, or nothing else."""
    held = F.pmod(F.xxhash64(F.coalesce(host, F.lit(""))), F.lit(folds)) == 0
    model = train_residue(rows.filter(~held), id_col, text_col)
    if model is None:
        return rows.sparkSession.createDataFrame([], _REPORT)
    return _report(model.scored(rows.filter(held), id_col, text_col, ()), model.threshold)


def residue_on_unseen_kinds(rows: DataFrame, id_col: str, text_col: str, folds: int = 4, thresholds: tuple[float, ...] = (0.1, 0.3, 0.5, 0.7)) -> DataFrame:
    """(threshold, n_docs, n_weak, n_found, n_both, recall): how many of the documents that only kinds of weak labels show
    which the classifier never saw it finds, and how many documents without any weak label.

    Kinds are left out in ``folds`` turns, a share of them each; the counts are sums over the turns: ``n_weak`` documents with a left-out
    kind, ``n_both`` found of these, ``n_docs`` documents without any label and ``n_found`` found of these."""
    names = sorted(KINDS)
    scores = []
    for f in range(folds):
        left_out = tuple(names[f::folds])
        model = train_residue(rows, id_col, text_col, left_out=left_out)
        if model is not None:
            scores.append(model.scored(rows, id_col, text_col, left_out))
    if not scores:
        return rows.sparkSession.createDataFrame([], "threshold double, n_docs bigint, n_weak bigint, n_found bigint, n_both bigint, recall double")
    whole = scores[0]
    for part in scores[1:]:
        whole = whole.unionByName(part)
    each = whole.select("*", F.explode(F.array(*[F.lit(t) for t in thresholds])).alias("threshold"))
    found = F.col("score") >= F.col("threshold")
    out = each.groupBy("threshold").agg(
        F.count_if(~F.col("weak")).alias("n_docs"), F.count_if("held").alias("n_weak"), F.count_if(~F.col("weak") & found).alias("n_found"), F.count_if(F.col("held") & found).alias("n_both")
    )
    return out.withColumn("recall", F.round(F.try_divide("n_both", "n_weak"), 6))
