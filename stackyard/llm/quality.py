"""Quality rules with distribution divergence (operator 3).

A document's distribution of character classes and of common words is
compared with its language's by Jensen-Shannon distance (base 2, in 0..1).
The references come from the corpus itself, over all of its rows:

1. Candidate words. Each chunk of texts reports the words that make up at
   least half of ``common_share`` of its words in a language. A word with
   ``common_share`` of a language's words is then reported by chunks that hold
   at least half of that, so the candidates with that much (at most
   2 / common_share of them in a language) miss none.
2. Features of every document: base counts, class counts, counts of the
   candidates.
3. References: sums over the documents that pass the base rules.
4. Verdicts: distances against the references, with minimum-length guards.

Documents whose language is null or has less than ``own_share`` of the rows
form one group, so the broadcast references have at most 1 / own_share + 1
rows of at most 2 / common_share words each.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import row_hash, saved, stream_texts, without
from .tokens import chunks
from .words import SPACE, Texts, window_hashes

#: Character classes by the first byte of a character.
CLASSES = ("lower", "upper", "digit", "space", "sentence", "symbol", "other_ascii", "control",
           "two_byte", "three_byte", "four_byte")
_CLASS = np.full(256, -1)
_CLASS[0:0x20] = 7
_CLASS[0x7F] = 7
_CLASS[0x21:0x7F] = 6
_CLASS[np.flatnonzero(SPACE)] = 3
_CLASS[ord("a"):ord("z") + 1] = 0
_CLASS[ord("A"):ord("Z") + 1] = 1
_CLASS[ord("0"):ord("9") + 1] = 2
_CLASS[[ord(c) for c in ".,;:'\"?-()"]] = 4
SYMBOLS = [ord(c) for c in "#*$%&|<>"]
_CLASS[SYMBOLS] = 5
_CLASS[0xC0:0xE0] = 8
_CLASS[0xE0:0xF0] = 9
_CLASS[0xF0:] = 10

#: The group of null and rare languages.
REST = "\0rest"

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
REPEAT_WINDOW = 8


def base_counts(texts: list[bytes], t: Texts, h: np.ndarray) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, and the class counts."""
    n = len(texts)
    bytes_of = np.zeros((n, 256), np.int64)
    dup_lines = np.zeros(n, np.int64)
    for i, text in enumerate(texts):
        bytes_of[i] = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
        if b"\n" in text:
            lines = [x for x in text.split(b"\n") if x and not x.isspace()]
            dup_lines[i] = len(lines) - len(set(lines))
    lead = _CLASS >= 0
    classes = np.zeros((n, len(CLASSES)), np.int64)
    for c in range(len(CLASSES)):
        classes[:, c] = bytes_of[:, _CLASS == c].sum(axis=1)
    repeat = np.zeros(n, np.int64)
    w = REPEAT_WINDOW
    at = np.flatnonzero(t.whole_windows(w))
    if len(at):
        # equal windows of one text: equal (hash, text)
        key = window_hashes(h, w)[at] + t.text_of[at].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        order = np.argsort(key, kind="stable")
        same = np.zeros(len(at), bool)
        eq = (key[order][1:] == key[order][:-1]) & (t.text_of[at][order][1:] == t.text_of[at][order][:-1])
        same[order[1:][eq]] = True
        same[order[:-1][eq]] = True
        cover = np.zeros(len(h) + 1, np.int64)
        np.add.at(cover, at[same], 1)
        np.add.at(cover, at[same] + w, -1)
        repeat = np.bincount(t.text_of[np.cumsum(cover)[:-1] > 0], minlength=n)
    return {"n_words": t.n_words, "word_chars": bytes_of[:, lead & ~SPACE].sum(axis=1),
            "n_symbols": bytes_of[:, SYMBOLS].sum(axis=1), "n_dup_lines": dup_lines,
            "n_repeat_words": repeat, "classes": classes}


def js_distance(p: np.ndarray, q: np.ndarray) -> float:
    """Jensen-Shannon distance of two count vectors; 0 if either is empty."""
    if not p.sum() or not q.sum():
        return 0.0
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2

    def bits(a):
        k = a > 0
        return float((a[k] * np.log2(a[k] / m[k])).sum())

    return float(np.sqrt(max(0.0, (bits(p) + bits(q)) / 2)))


def _candidates(docs: DataFrame, cols: tuple[str, str, str], share: float) -> DataFrame:
    """(lang, word): at most 2 / share words of each language."""
    def count(batches):
        for b in batches:
            langs, out = b.column("lang").to_pylist(), ([], [], [], [])
            for ls, texts in chunks(langs, b.column("text").to_pylist()):
                t = Texts(texts, lower=True)
                h = t.hashes()
                rows = defaultdict(list)
                for i, x in enumerate(ls):
                    rows[x].append(i)
                for lang, idx in rows.items():
                    own = h if len(idx) == len(texts) else h[np.isin(t.text_of, idx)]
                    word, n = np.unique(own, return_counts=True)
                    k = n >= share / 2 * len(own)
                    # the language's total goes along on a row without a word
                    for c, v in zip(out, ([lang] * (k.sum() + 1), [*word[k].view(np.int64).tolist(), None],
                                          [*n[k].tolist(), 0], [0] * k.sum() + [len(own)])):
                        c.extend(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, x) for c, x in zip(out, (pa.string(), pa.int64(), pa.int64(), pa.int64()))],
                                             names=["lang", "word", "n", "total"])

    id_col, text_col, lang_col = cols
    d = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"),
                    F.col(f"`{lang_col}`").cast("string").alias("lang"))
    counts = saved(stream_texts(d, "doc_id", "text", count, "lang string, word long, n long, total long", ["lang"])
                   .groupBy("lang", "word").agg(F.sum("n").alias("n"), F.sum("total").alias("total")), "quality-words")
    totals = counts.where("word is null").select("lang", F.col("total").alias("_all"))
    return counts.where("word is not null").join(totals, "lang").where(F.col("n") >= share / 2 * F.col("_all")).select("lang", "word")


def judge_documents(docs: DataFrame, char_distance: float = 0.32, word_distance: float = 0.40,
                    min_chars: int = 200, min_words: int = 50, common_share: float = 0.005,
                    own_share: float = 0.001, id_col: str = "doc_id", text_col: str = "text",
                    lang_col: str = "lang") -> DataFrame:
    """One row per input row: doc_id, ``th`` (hash of text and language), base
    counts, base verdict, distances, ``kept``.

    ``char_js`` and ``word_js`` are null where the guards (``min_chars``
    characters in words, ``min_words`` words) find the text too short to
    compare; such texts stand by their base verdict. Null texts have no
    words and fail; null and rare languages are one group; an empty table
    gives an empty result; repeated rows are judged alike.
    """
    cols = (id_col, text_col, lang_col)
    spark = docs.sparkSession
    d = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"),
                    F.col(f"`{lang_col}`").cast("string").alias("lang"), row_hash(text_col, lang_col).alias("th"))
    n_docs = d.count()
    # at most 1 / own_share languages
    own = {r[0] for r in d.groupBy("lang").count().where(F.col("lang").isNotNull() & (F.col("count") >= own_share * n_docs))
           .select("lang").collect()}
    rest = F.lit(REST)
    named = d.withColumn("lang", F.when(F.col("lang").isin(*own), F.col("lang")).otherwise(rest) if own else rest)
    words = defaultdict(list)
    for r in _candidates(named, ("doc_id", "text", "lang"), common_share).collect():
        words[r["lang"]].append(r["word"])
    vocab = spark.sparkContext.broadcast({k: np.sort(np.array(v, np.int64)) for k, v in words.items()})
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def features(batches):
        ref = vocab.value
        for b in batches:
            out: dict[str, list] = defaultdict(list)
            rows = list(zip(*(b.column(c).to_pylist() for c in ("doc_id", "lang", "th"))))
            for own_rows, texts in chunks(rows, b.column("text").to_pylist()):
                t = Texts(texts)
                h = t.hashes()
                base = base_counts(texts, t, h)
                low = Texts(texts, lower=True).hashes().view(np.int64)
                for i, (doc_id, lang, th) in enumerate(own_rows):
                    v = ref.get(lang, np.zeros(0, np.int64))
                    own = low[t.first[i]:t.first[i + 1]]
                    at = np.searchsorted(v, own)
                    hit = at < len(v)
                    hit[hit] = v[at[hit]] == own[hit]
                    n = np.bincount(at[hit], minlength=len(v))
                    n = np.append(n, len(own) - n.sum())  # last: all other words
                    k = np.flatnonzero(n)
                    out["doc_id"].append(doc_id)
                    out["lang"].append(lang)
                    out["th"].append(th)
                    out["word_at"].append(k)
                    out["word_n"].append(n[k])
                for c in names:
                    out[c].extend(base[c].tolist())
                out["classes"].extend(base["classes"])
            ints = pa.list_(pa.int64())
            types = {"doc_id": pa.int64(), "lang": pa.string(), "word_at": ints, "word_n": ints, "classes": ints}
            order = ["doc_id", "th", "lang", *names, "classes", "word_at", "word_n"]
            yield pa.RecordBatch.from_arrays([pa.array(out[c], types.get(c, pa.int64())) for c in order], names=order)

    schema = ("doc_id long, th long, lang string, " + ", ".join(f"{c} long" for c in names)
              + ", classes array<long>, word_at array<long>, word_n array<long>")
    f = saved(stream_texts(named, "doc_id", "text", features, schema, ["lang", "th"]), "quality-features")
    f = f.withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                     | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))
    good = f.where(~F.col("base_failed"))
    # references: a row for each (language, class or word)
    by_class = good.select("lang", F.posexplode("classes").alias("at", "n")).groupBy("lang", "at").agg(F.sum("n").alias("n"))
    by_word = (good.select("lang", F.explode(F.arrays_zip("word_at", "word_n")).alias("w"))
               .groupBy("lang", F.col("w.word_at").alias("at")).agg(F.sum("w.word_n").alias("n")))
    chars: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(len(CLASSES)))
    for r in by_class.collect():  # at most (1 / own_share + 1) x classes
        chars[r["lang"]][r["at"]] += r["n"]
    seen = {k: np.zeros(len(v) + 1) for k, v in vocab.value.items()}
    for r in by_word.collect():
        seen.setdefault(r["lang"], np.zeros(1))[r["at"]] += r["n"]
    refs = {}
    for lang in own | {REST}:
        n = seen.get(lang, np.zeros(1)).copy()
        common = np.zeros(len(n), bool)
        common[:-1] = n[:-1] >= common_share * max(1.0, n.sum())
        refs[lang] = (chars[lang], n, common)
    table = spark.sparkContext.broadcast(refs)

    def distances(batches):
        ref = table.value
        for b in batches:
            char_js, word_js = [], []
            rows = zip(*(b.column(c).to_pylist() for c in ("lang", "n_words", "word_chars", "classes", "word_at", "word_n")))
            for lang, n_words, n_chars, classes, at, n in rows:
                c_ref, w_ref, common = ref[lang]
                char_js.append(js_distance(np.array(classes, float), c_ref) if n_chars >= min_chars else None)
                if n_words < min_words:
                    word_js.append(None)
                    continue
                own = np.zeros(len(w_ref))
                own[at] = n
                fold = lambda x: np.append(x[common], x[~common].sum())
                word_js.append(js_distance(fold(own), fold(w_ref)))
            keep = [b.column(c) for c in ["doc_id", "th", *names, "base_failed"]]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(char_js, pa.float64()), pa.array(word_js, pa.float64())],
                                             names=["doc_id", "th", *names, "base_failed", "char_js", "word_js"])

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    out = f.mapInArrow(distances, "doc_id long, th long, " + ", ".join(f"{c} long" for c in names)
                       + ", base_failed boolean, char_js double, word_js double")
    far = (F.coalesce(F.col("char_js"), F.lit(0.0)) > char_distance) | (F.coalesce(F.col("word_js"), F.lit(0.0)) > word_distance)
    return out.withColumn("kept", ~F.col("base_failed") & ~far)


def keep_good(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **options) -> DataFrame:
    """The rows of ``docs`` that :func:`judge_documents` keeps, all columns."""
    judged = judge_documents(docs, id_col=id_col, text_col=text_col, lang_col=lang_col, **options)
    return without(docs, judged.where(~F.col("kept")), id_col, text_col, lang_col)
