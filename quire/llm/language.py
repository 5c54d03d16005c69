"""Language of documents and of their paragraphs, by compression.

A paragraph is compressed once per language with a zstandard dictionary that holds raw sample text of that
language; the language whose dictionary leaves the fewest bytes wins.  Confidence is the margin to the runner-up
as a share of the runner-up's size; below ``min_margin`` the paragraph is rejected and gets no language.  A
document's language is that of most of its words; where all paragraphs are rejected, its whole text is judged at once.

The dictionaries are fitted on a bounded sample: at most ``sample_rows`` labelled rows and ``sample_bytes`` bytes
of each language, so what is broadcast does not grow with the data.
"""

from __future__ import annotations

import re
import unicodedata

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quire.functions.whitespace import UNICODE_WS
from quire.plans.materialize import spread

SAMPLE_ROWS = 1_000
SAMPLE_BYTES = 64 << 10
MIN_MARGIN = 0.05
LEVEL = 1

_MARKS = regex.compile(r"\p{M}+")
_WORD = re.compile(r"[^\W\d_]+")
_BLANK = re.compile(f"[{UNICODE_WS}]*")
_LINE = re.compile("\r?\n")

#: Codes and names of the languages, without region and in lower case without accents.
NAMES = {
    "en": ("en", "eng", "english", "anglais", "ingles", "englisch", "kiingereza"),
    "fr": ("fr", "fra", "fre", "french", "francais", "frances", "franzosisch", "kifaransa"),
    "es": ("es", "spa", "esp", "spanish", "espanol", "castellano", "castilian", "espagnol", "spanisch"),
    "pt": ("pt", "por", "portuguese", "portugues", "portugais", "portugiesisch"),
    "de": ("de", "deu", "ger", "german", "deutsch", "allemand", "aleman", "alemao"),
    "sw": ("sw", "swa", "swh", "swahili", "kiswahili"),
}
CODE_OF = {name: code for code, names in NAMES.items() for name in names}


def normal(text: str) -> str:
    """Lower-case words without accents, digits and punctuation: what the compressor sees."""
    if not text.isascii():
        text = _MARKS.sub("", unicodedata.normalize("NFKD", text))
    return " ".join(_WORD.findall(text.lower()))


def label_language(label: str | None) -> str | None:
    """The code that a label means; null for a missing or unknown label.

    A language outside the table is returned as written, since it is a label, only another language.
    """
    plain = _MARKS.sub("", unicodedata.normalize("NFKD", label or "")).strip().lower()
    if plain in CODE_OF:
        return CODE_OF[plain]
    first = re.split(r"[-_@. (]", plain)[0]
    return CODE_OF.get(first, first or None)


def paragraphs(text: str) -> list[str]:
    """Maximal runs of non-blank lines; lines end by LF or CRLF."""
    out: list[list[str]] = [[]]
    for line in _LINE.split(text):
        if not _BLANK.fullmatch(line):
            out[-1].append(line)
        elif out[-1]:
            out.append([])
    return ["\n".join(p) for p in out if p]


class Classifier:
    """One compressor per language."""

    def __init__(self, samples: dict[str, str], level: int = LEVEL):
        import zstandard

        self.languages = sorted(samples)
        self.compress = []
        for language in self.languages:
            known = zstandard.ZstdCompressionDict(samples[language].encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            known.precompute_compress(level=level)
            self.compress.append(zstandard.ZstdCompressor(level=level, dict_data=known, write_checksum=False, write_content_size=False, write_dict_id=False).compress)

    def __call__(self, plain: str) -> tuple[str | None, float]:
        """(language, margin) of a normalised text; no language without samples."""
        if not self.compress:
            return None, 0.0
        data = plain.encode()
        sizes = [len(c(data)) for c in self.compress]
        best = min(sizes)
        k = sizes.index(best)
        second = min(sizes[:k] + sizes[k + 1 :], default=best)
        return self.languages[k], (second - best) / max(1, second)


def fit(samples: DataFrame, lang: str, text: str, order: str, sample_rows: int = SAMPLE_ROWS, sample_bytes: int = SAMPLE_BYTES) -> dict[str, str]:
    """Normalised sample text per language, within the bounds."""
    rows = samples.select(F.col(lang).alias("lang"), F.col(text).alias("body"), F.col(order).alias("o")).filter(F.col("lang").isNotNull() & (F.length("body") > 0))
    rows = rows.withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy("o", "body"))).filter(F.col("n") <= sample_rows)
    out: dict[str, bytes] = {}
    for r in rows.orderBy("lang", "n").collect():
        held = out.get(r["lang"], b"")
        if len(held) < sample_bytes:
            out[r["lang"]] = (held + b" " + normal(r["body"]).encode()).strip()[:sample_bytes]
    return {lang: held.decode(errors="ignore") for lang, held in out.items()}


SEGMENTS = "segment_no long, lang string, confidence double, n_words long, label string, doc_lang string"


def segments(docs: DataFrame, key: str, text: str, label: str, samples: dict[str, str], min_margin: float = MIN_MARGIN) -> DataFrame:
    """doc_id, segment_no, lang, confidence, n_words, label, doc_lang: one row per document (segment 0) and per paragraph (1, 2, ...).

    ``label`` is the language that the document's own label means, null if it has none.  Paragraphs of a narrow margin
    have a null ``lang``, and so has a document whose whole text has a narrow margin or no letters (confidence 0).
    Paragraphs without letters and null texts have no rows.  Repeated rows give repeated segments; keys keep their type.
    """
    keys = docs.schema[key].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(samples)

    def run(batches):
        import pyarrow.compute as pc

        classify, labels = Classifier(shared.value), {}
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [], [], [], [])
            for doc, body, given in zip(batch.column(0).to_pylist(), batch.column(1), pc.cast(batch.column(2), pa.string()).to_pylist(), strict=True):
                body = body.as_py()
                if body is None:
                    continue
                if given not in labels:
                    labels[given] = label_language(given)
                found, votes = [], {}
                for no, p in enumerate(paragraphs(body), 1):
                    plain = normal(p)
                    if not plain:
                        continue
                    lang, margin = classify(plain)
                    n = plain.count(" ") + 1
                    if margin < min_margin:
                        lang = None
                    else:
                        w = votes.setdefault(lang, [0, 0.0])
                        w[0] += n
                        w[1] += n * margin
                    found.append((doc, no, lang, margin, n, labels[given]))
                total = sum(f[4] for f in found)
                if votes:
                    top = max(sorted(votes), key=lambda x: votes[x][0])
                    sure = votes[top][1] / total
                else:
                    top, sure = classify(normal(body)) if found else (None, 0.0)
                    if sure < min_margin:
                        top = None
                found.append((doc, 0, top, sure, total, labels[given]))
                for row in found:
                    for c, v in zip(out, (*row, top), strict=True):
                        c.append(v)
            types = (batch.schema.field(0).type, pa.int64(), pa.string(), pa.float64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names=["doc_id", "segment_no", "lang", "confidence", "n_words", "label", "doc_lang"])

    return docs.select(F.col(key), F.col(text), F.col(label)).mapInArrow(run, f"doc_id {keys}, {SEGMENTS}")


def mislabelled(rows: DataFrame) -> DataFrame:
    """Of segments(): segment 0 where the label is missing or wrong, and every paragraph in another language than most words of its text.

    What has no language is not reported.
    """
    wrong = F.when(F.col("segment_no") == 0, ~F.col("lang").eqNullSafe(F.col("label"))).otherwise(F.col("lang") != F.col("doc_lang"))
    return rows.filter(F.col("lang").isNotNull() & wrong)


def document_segments(spark, sf_dir: str) -> DataFrame:
    from quire.sources.tables import read_table

    samples = fit(read_table(spark, sf_dir, "lang_samples"), "lang", "text", "sample_id")
    return segments(spread(read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")), "doc_id", "text", "lang", samples)


def documents_found(spark, sf_dir: str) -> DataFrame:
    return mislabelled(document_segments(spark, sf_dir)).select("doc_id", "segment_no", "lang").distinct()
