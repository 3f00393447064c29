"""Languages of documents and of their lines (p10): segmentation-marginalised unigram models.

Each language has a probability for every piece of one fixed public vocabulary. A word's probability in a language is the
sum over all its segmentations into pieces, by the forward algorithm for all languages at once; a text's is the product
over its words. The distinct words of a batch are scored together, once per worker. The models are fitted by expectation-maximisation on at most
``FIT_DOCS`` labelled documents per language (checked labels first, then the documents' own labels, smallest hash first),
refitted once on the lines of these that agree with the first fit.

Defined results: null, blank, numeric, symbolic and code-only texts have no language and give no row; of equally probable
languages the alphabetically first; texts whose letters none of the languages has have none; a missing, empty or unknown label counts as missing; lines are split at ``\\n`` and
numbered from 1; repeated rows each give their rows; without any labelled document nothing is found.
"""

from __future__ import annotations

import base64
import functools
import re
import unicodedata
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import table

VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: Bound of the sample that the models are fitted on: documents per language, and the longest text among them.
FIT_DOCS, FIT_CHARS = 80, 6_000
LONGEST = 12  # letters of a piece
LONGEST_RUN = 12  # letters of a word that has no more than two different ones
LONGEST_FITTED = 60  # letters of a word that are fitted together
WORDS_AT_ONCE = 100_000
FOREIGN = -9.0  # log probability a letter, below which a text is in none of the languages (about -3 in its own)
UNKNOWN = 1e-7  # probability of a letter that is no piece
SMOOTH = 0.02  # pseudo count of a piece
MARGIN = 6.0  # nats by which a line's language must lead over the document's for the document to be mixed
MIXED_LETTERS = 12  # and the letters such a line must have

# Names and codes that labels use for a language.
LABELS = {
    "en": "eng english englisch anglais", "de": "deu ger german deutsch allemand", "fr": "fra fre french francais franzosisch", "es": "spa spanish espanol castellano",
    "pt": "por portuguese portugues", "it": "ita italian italiano", "nl": "nld dut dutch nederlands", "ru": "rus russian русский", "pl": "pol polish polski",
    "zh": "zho chi cmn chinese mandarin 中文", "ja": "jpn japanese nihongo 日本語", "sv": "swe swedish svenska", "da": "dan danish dansk", "no": "nor nob nno nb nn norwegian norsk",
    "fi": "fin finnish suomi", "cs": "ces cze czech cestina", "tr": "tur turkish turkce", "ko": "kor korean 한국어", "ar": "ara arabic", "uk": "ukr ukrainian", "hu": "hun hungarian magyar",
    "ro": "ron rum romanian romana", "el": "ell gre greek", "he": "heb hebrew", "hi": "hin hindi", "vi": "vie vietnamese", "id": "ind indonesian", "th": "tha thai", "ca": "cat catalan catala",
}
CODES = {name: code for code, names in LABELS.items() for name in [code, *names.split()]}
NO_LABEL = {"", "und", "unknown", "unk", "none", "null", "n/a", "na", "mul", "zxx", "mis", "other", "?", "-", "xx"}

CJK = "々-〇぀-ヿㇰ-ㇿ㐀-䶿一-鿿ｦ-ﾟ"
WORD = re.compile(f"[{CJK}]+|[^\\W\\d_{CJK}]+")
CODE = re.compile(r"[(){}\[\];=<>*/\\_$#|&^~+@]|--")


def label_code(label: str | None) -> str:
    """Two letters for any form of a language's name or code; empty if the label says nothing known."""
    if label is None:
        return ""
    text = "".join(c for c in unicodedata.normalize("NFD", label.strip().lower()) if not unicodedata.combining(c))
    if text in NO_LABEL:
        return ""
    return CODES.get(text) or CODES.get(re.split(r"[-_ (]", text)[0], text)


def words_of(line: str) -> list[str]:
    if not line.isascii():
        line = unicodedata.normalize("NFKC", line)
        line = "".join(c for c in line if c.isalpha() or unicodedata.category(c) not in ("Cf", "Mn"))
    # a long run of one or two letters is no word
    return [w for w in WORD.findall(line.casefold()) if len(w) <= LONGEST_RUN or len(set(w)) > 2]


def has_language(line: str, words: list[str]) -> bool:
    """Whether a line holds language: letters enough, and not a line of code."""
    letters = sum(map(len, words))
    if letters < 2 or not any(len(w) > 1 or "　" < w for w in words):
        return False
    return len(CODE.findall(line)) <= 0.1 * letters


@functools.lru_cache(2)
def pieces(path: str) -> dict[str, int]:
    """Folded pieces of letters of the public vocabulary; words begin with a mark."""
    out: dict[str, int] = {}
    with open(path, "rb") as f:
        for line in f:
            try:
                text = base64.b64decode(line.split()[0]).decode("utf-8")
            except UnicodeDecodeError:
                continue
            mark, core = ("▁" if text.startswith(" ") else ""), text.strip().casefold()
            if core and core.isalpha() and len(core) <= LONGEST:
                out.setdefault(mark + core, len(out))
    out.setdefault("▁", len(out))
    return out


class Model:
    """Piece probabilities of each language; scores words and lines."""

    def __init__(self, languages: list[str], path: str = VOCABULARY):
        self.languages, self.path = languages, path
        self.index = pieces(path)
        self.p = np.full((len(self.index), len(languages)), 1.0 / len(self.index))
        self.forget()

    def __getstate__(self):
        return {"languages": self.languages, "path": self.path, "p": self.p.astype(np.float32)}

    def __setstate__(self, state):
        self.languages, self.path, self.p = state["languages"], state["path"], state["p"].astype(np.float64)
        self.index = pieces(self.path)
        self.forget()

    def forget(self) -> None:
        self.rows: dict[str, int] = {}
        self.table = np.zeros((1024, len(self.languages)))

    def arcs(self, word: str) -> tuple[str, list[list[tuple[int, int]]]]:
        """For each end position the (start, piece) pairs of the pieces that end there."""
        text = marked(word)
        get = self.index.get
        return text, [[(i, k) for i in range(max(0, j - LONGEST - 1), j) if (k := get(text[i:j])) is not None] for j in range(1, len(text) + 1)]

    def forward(self, texts: list[str]) -> np.ndarray:
        """Log probability in each language of words of one length, marked: all segmentations summed, all words at once."""
        n, size, get = len(texts), len(texts[0]), self.index.get
        alpha, shift = [np.ones((n, len(self.languages)))], np.zeros(n)
        for j in range(1, size + 1):
            at = alpha[j - 1] * UNKNOWN
            for i in range(max(0, j - LONGEST - 1), j):
                hits = [(w, k) for w, t in enumerate(texts) if (k := get(t[i:j])) is not None]
                if hits:
                    w, k = np.array(hits).T
                    at[w] += alpha[i][w] * self.p[k]
            alpha.append(at)
            if j % 20 == 0:  # long runs: keep the numbers in range
                top = at.max(1)
                for i in range(max(0, j - LONGEST - 1), j + 1):
                    alpha[i] = alpha[i] / top[:, None]
                shift += np.log(top)
            if j > LONGEST + 1:
                alpha[j - LONGEST - 2] = None
        return np.log(np.maximum(alpha[-1], 1e-300)) + shift[:, None]

    def scores(self, words: list[str]) -> np.ndarray:
        """A row of log probabilities for each word. Distinct words are scored once, those of one length together, and kept
        for the batches that follow."""
        if len(self.rows) > 400_000:
            self.forget()
        by_length: dict[int, list[str]] = defaultdict(list)
        for w in set(words).difference(self.rows):
            by_length[len(marked(w))].append(w)
        for size, group in by_length.items():
            step = max(1, 40_000 // size)
            for at in range(0, len(group), step):
                part = group[at : at + step]
                first = len(self.rows)
                while first + len(part) > len(self.table):
                    self.table = np.concatenate([self.table, np.zeros_like(self.table)])
                self.table[first : first + len(part)] = self.forward([marked(w) for w in part])
                self.rows.update(zip(part, range(first, first + len(part))))
        rows = self.rows
        return self.table[[rows[w] for w in words]]

    def score(self, word: str) -> np.ndarray:
        return self.scores([word])[0]

    def fit(self, counts: dict[str, np.ndarray], rounds: int = 2) -> None:
        """Expectation-maximisation from the words' counts in each language."""
        first = np.full(self.p.shape, SMOOTH)
        lattices = {w: self.arcs(w) for w in counts}
        for w, c in counts.items():
            for ends in lattices[w][1]:
                for i, k in ends:
                    first[k] += c
        self.p = first / first.sum(0)
        for _ in range(rounds):
            got = np.full(self.p.shape, SMOOTH)
            for w, c in counts.items():
                text, arcs = lattices[w]
                n = len(text)
                alpha, beta = [np.ones(len(self.languages))], [np.zeros(len(self.languages))] * n + [np.ones(len(self.languages))]
                for j, ends in enumerate(arcs):
                    at = alpha[j] * UNKNOWN
                    for i, k in ends:
                        at = at + alpha[i] * self.p[k]
                    alpha.append(at)
                for j in range(n, 0, -1):
                    for i, k in arcs[j - 1]:
                        beta[i] = beta[i] + self.p[k] * beta[j]
                    beta[j - 1] = beta[j - 1] + UNKNOWN * beta[j]
                scale = c / np.maximum(alpha[-1], 1e-300)
                for j in range(n):
                    for i, k in arcs[j]:
                        got[k] += alpha[i] * self.p[k] * beta[j + 1] * scale
            self.p = got / got.sum(0)
        self.forget()

    def lines(self, lines: list[list[str]]) -> np.ndarray:
        """A row of log probabilities for each line, which has a word at least."""
        out, at = [np.zeros((0, len(self.languages)))], 0
        while at < len(lines):
            end, load = at, 0
            while end < len(lines) and (load < WORDS_AT_ONCE or end == at):
                load += len(lines[end])
                end += 1
            starts = np.cumsum([0] + [len(x) for x in lines[at : end - 1]])
            out.append(np.add.reduceat(self.scores([w for x in lines[at:end] for w in x]), starts))
            at = end
        return np.concatenate(out)


def marked(word: str) -> str:
    """A word with the mark of its beginning; words of scripts without spaces have none."""
    return word if "　" < word[0] else "▁" + word


def counted(model_languages: list[str], samples: list[tuple[str, list[str]]]) -> dict[str, np.ndarray]:
    at = {lang: i for i, lang in enumerate(model_languages)}
    out: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(len(at)))
    for lang, words in samples:
        # long runs (scripts without spaces) are fitted in parts
        for w, n in Counter(w[i : i + LONGEST_FITTED] for w in words for i in range(0, len(w), LONGEST_FITTED)).items():
            out[w][at[lang]] += n
    return out


def fit_models(docs: DataFrame, labels: DataFrame | None) -> Model | None:
    """Models of all languages that labels name. ``docs``: doc_id, text, lang; ``labels``: doc_id, lang, checked."""
    code = F.pandas_udf(lambda s: s.map(label_code), T.StringType())
    texts = docs.filter(F.length("text").between(20, FIT_CHARS)).select("doc_id", "text", "lang")
    said = texts.select("doc_id", "text", code("lang").alias("lang"), F.lit(1).alias("rank"))
    if labels is not None:
        checked = labels.select("doc_id", code("lang").alias("checked")).dropDuplicates(["doc_id"])
        # the checked labels grow with the corpus: an ordinary join
        said = said.join(checked, "doc_id", "left").select("doc_id", "text", F.coalesce("checked", "lang").alias("lang"), F.when(F.col("checked").isNull(), 1).otherwise(0).alias("rank"))
    pick = Window.partitionBy("lang").orderBy("rank", F.xxhash64("doc_id"), "doc_id")
    # any code of two or three letters is a language, whether or not LABELS knows other names for it
    sample = said.filter(F.col("lang").rlike("^[a-z]{2,3}$")).withColumn("rn", F.row_number().over(pick)).filter(F.col("rn") <= FIT_DOCS).select("lang", "text", "rank")
    rows = [(r["lang"], r["text"], r["rank"]) for r in sample.collect()]  # at most FIT_DOCS texts of FIT_CHARS a language
    if not rows:
        return None
    # a language that a single unchecked label names is a wrong label rather than a language
    enough, checked = Counter(lang for lang, _, _ in rows), {lang for lang, _, rank in rows if rank == 0}
    languages = sorted(lang for lang, n in enough.items() if n >= 2 or lang in checked or len(enough) == 1) or sorted(enough)
    rows = [(lang, [w for x in text.split("\n") if has_language(x, w := words_of(x))]) for lang, text, _ in rows if lang in languages]
    model = Model(languages)
    model.fit(counted(languages, [(lang, w) for lang, lines in rows for w in lines]), 1)
    said_by = [w for _, lines in rows for w in lines]
    agreed = [(languages[k], w) for k, w in zip(model.lines(said_by).argmax(1), said_by)] if said_by else []
    model.fit(counted(languages, agreed), 2)
    return model


def lines_with_language(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, said, line_no, letters, lang, confidence, doc_lang, doc_confidence, mixed of each line that holds language."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        names = np.array(m.languages, object)
        for b in batches:
            doc, number, letters, words = [], [], [], []
            for d, text in enumerate(b["text"]):
                if isinstance(text, str):
                    for n, x in enumerate(text.split("\n"), 1):
                        found = words_of(x)
                        if has_language(x, found):
                            doc.append(d)
                            number.append(n)
                            letters.append(len(x.strip()))
                            words.append(found)
            s = m.lines(words)
            size = np.array([sum(map(len, w)) for w in words], np.int64)
            native = s.max(1) >= FOREIGN * size if len(s) else np.zeros(0, bool)
            s, doc, number, letters = s[native], np.array(doc, np.int64)[native], np.array(number, np.int32)[native], np.array(letters, np.int32)[native]
            own = s.argmax(1) if len(s) else np.zeros(0, np.int64)
            share = np.zeros((len(b), len(names)))
            np.add.at(share, (doc, own), letters)
            total = np.zeros_like(share)
            np.add.at(total, doc, s)
            main = share.argmax(1)
            leads = s.max(1) - s[np.arange(len(s)), main[doc]] > MARGIN if len(s) else np.zeros(0, bool)
            mixed = np.zeros(len(b), bool)
            mixed[doc[leads & (letters >= MIXED_LETTERS)]] = True
            main = np.where(mixed, main, total.argmax(1))
            sure = np.where(mixed, share[np.arange(len(b)), main] / np.maximum(share.sum(1), 1), posterior(total, main))
            best = np.where(mixed[doc], own, main[doc])
            yield pd.DataFrame({
                "doc_id": b["doc_id"].to_numpy()[doc], "said": b["lang"].to_numpy()[doc], "line_no": number, "letters": letters, "lang": names[best], "confidence": posterior(s, best),
                "doc_lang": names[main[doc]], "doc_confidence": sure[doc], "mixed": mixed[doc],
            })

    return docs.filter("doc_id IS NOT NULL").select("doc_id", "text", "lang").mapInPandas(run, "doc_id long, said string, line_no int, letters int, lang string, confidence double, doc_lang string, doc_confidence double, mixed boolean")


def posterior(scores: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For each row the probability of the language at ``at``."""
    return 1.0 / np.exp(np.clip(scores - scores[np.arange(len(scores)), at][:, None], -700, 50)).sum(1)


def languages_of(spark, sf_dir: str) -> DataFrame | None:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = fit_models(docs, table(spark, sf_dir, "lang_labels"))
    if model is None:
        return spark.createDataFrame([], "doc_id long, said string, line_no int, letters int, lang string, confidence double, doc_lang string, doc_confidence double, mixed boolean")
    return lines_with_language(docs, model)


def p10_found(spark, sf_dir: str) -> DataFrame:
    code = F.pandas_udf(lambda s: s.map(label_code), T.StringType())
    found = languages_of(spark, sf_dir)
    per_line = found.filter("mixed").select("doc_id", "line_no", "lang")
    whole = found.groupBy("doc_id").agg(F.first("said").alias("said"), F.first("doc_lang").alias("lang"))
    wrong = whole.filter(code("said") != F.col("lang")).select("doc_id", F.lit(0).alias("line_no"), "lang")
    return wrong.unionByName(per_line)


def p10_documents(spark, sf_dir: str) -> DataFrame:
    """Each document that holds language: its language, confidence, and whether it mixes several."""
    found = languages_of(spark, sf_dir)
    return found.groupBy("doc_id").agg(F.first("doc_lang").alias("lang"), F.first("doc_confidence").alias("confidence"), F.first("mixed").alias("mixed"))
