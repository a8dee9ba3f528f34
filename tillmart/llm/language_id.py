"""Language by cross-parsing: the language whose text needs the fewest phrases to write a document.

For each language a suffix automaton of labelled text accepts every substring of it. A document
is cut from left to right into the longest phrases that the automaton accepts; a character it
lacks is a phrase of its own. Phrases per character estimate the cross entropy. Letters count
without case, and whatever lies between words as one blank.

Text in a language that was learned needs fewer phrases than the same letters backwards; letters in
no learned order, noise or another language, need about as many either way.
"""

import unicodedata
from collections import namedtuple
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmart.llm.blocks import arrow_map, bounded, plain_text
from tillmart.llm.frames import named_columns, numbered_columns
from tillmart.workspace import stage

SAMPLE_CHARS = 25_000
SAMPLE_DOCUMENT_CHARS = 2_000
SLICES = 4
BLOCK_CHARS = 1024
UNKNOWN = "und"
#: Texts that take fewer phrases backwards are too short to tell whether their letters are in order.
FEWEST_BACKWARDS = 20

_OTHER, _BLANK = 0, 1

#: languages: names; classes: of each code point (a blank if it belongs to no word, _OTHER if no language has it); first: (language, class) -> state or -1; automata: those of all languages, whose starts are in roots
Model = namedtuple("Model", "languages classes first roots automata")


class Transitions:
    """Sparse transitions: a state's lie in one table, as far from its base as their class says, between those of others.

    Bases are drawn at random until no two transitions share a cell, the states with most first.
    """

    def __init__(self, rows: list[dict[int, int]], alphabet: int):
        count = np.array([len(row) for row in rows], np.int64)
        owner = np.repeat(np.arange(len(rows)), count)
        classes = np.fromiter((c for row in rows for c in row), np.int64, len(owner))
        targets = np.fromiter((to for row in rows for to in row.values()), np.int64, len(owner))
        most = 3 * len(owner) + 1
        free, rng = np.ones(most + alphabet, bool), np.random.default_rng(1)
        self.base = np.zeros(len(rows), np.int64)
        ends = np.cumsum(count)
        for state in sorted(np.flatnonzero(count > 8).tolist(), key=lambda s: -count[s]):
            own, fits = classes[ends[state] - count[state]:ends[state]], np.zeros(0, bool)
            while not fits.any():
                tries = rng.integers(0, most, 64)
                fits = free[tries[:, None] + own].all(1)
            self.base[state] = tries[fits.argmax()]
            free[self.base[state] + own] = False
        left = np.flatnonzero(count[owner] <= 8)
        while len(left):
            self.base[owner[left]] = rng.integers(0, most, len(rows))[owner[left]]
            where = self.base[owner[left]] + classes[left]
            _, inverse, copies = np.unique(where, return_inverse=True, return_counts=True)
            taken = ~free[where] | (copies[inverse] > 1)
            again = np.bincount(owner[left], taken, len(rows))[owner[left]] > 0
            free[where[~again]] = False
            left = left[again]
        # (state + 1) << 32 | target; a cell of no state is zero.
        self.cells = np.zeros(most + alphabet, np.int64)
        self.cells[self.base[owner] + classes] = (owner + 1) << 32 | targets

    def __getitem__(self, at):
        """-1 where there is no transition."""
        state, c = at
        cell = self.cells[self.base[state] + c]
        return np.where(cell >> 32 == state + 1, cell & 0xFFFFFFFF, -1)


def _automaton(codes: list[int]) -> list[dict[int, int]]:
    """Of each state its transitions; the smallest automaton of all substrings, state 0 is the start."""
    rows, link, length = [{}], [-1], [0]
    last = 0
    for c in codes:
        cur = len(rows)
        rows.append({})
        link.append(-1)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in rows[p]:
            rows[p][c] = cur
            p = link[p]
        if p < 0:
            link[cur] = 0
        else:
            q = rows[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                clone = len(rows)
                rows.append(dict(rows[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and rows[p].get(c) == q:
                    rows[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    return rows


def suffix_automaton(codes: list[int], alphabet: int) -> Transitions:
    """Transitions, -1 where there is none, of the smallest automaton of all substrings; state 0 is the start."""
    return Transitions(_automaton(codes), alphabet)


def train(texts: dict[str, list[str]], sample_chars: int = SAMPLE_CHARS) -> Model:
    """From some labelled texts per language; the first ``sample_chars`` characters of each are used.

    Every letter of these has a class of its own, in whatever script and of however many letters.
    """
    texts = {lang: "\n".join(parts)[:sample_chars].lower() for lang, parts in sorted(texts.items())}
    of_words = letters() | _marks()
    chosen = sorted({c for text in texts.values() for c in text if of_words[ord(c)]})
    classes = np.where(of_words, _OTHER, _BLANK).astype(np.int32)
    for i, c in enumerate(chosen, 2):
        for form in {c, *(f for f in (c.upper(), c.title()) if len(f) == 1 and f.lower() == c)}:
            classes[ord(form)] = i
    alphabet, rows, roots = len(chosen) + 2, [], []
    first = np.full((len(texts), alphabet), -1, np.int64)
    for k, text in enumerate(texts.values()):
        start = len(rows)
        roots.append(start)
        rows += [{c: start + to for c, to in row.items()} for row in _automaton(_classes_of([text], classes)[0].tolist())]
        first[k, [*rows[start]]] = [*rows[start].values()]
    return Model([*texts], classes, first, np.array(roots, np.int64), Transitions(rows, alphabet))


def _classes_of(texts: list[str], classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Classes of all texts one after the other, runs of blanks as one, and each text's length in them."""
    lengths = np.array([len(t) for t in texts], np.int64)
    codes = classes[np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")].astype(np.int32)
    keep = codes != _BLANK
    keep[1:] |= keep[:-1]
    begins = (np.cumsum(lengths) - lengths)[lengths > 0]
    keep[begins] = True
    count = np.concatenate([[0], np.cumsum(keep)])
    ends = np.cumsum(lengths)
    return codes[keep], count[ends] - count[ends - lengths]


def phrases(texts: list[str], model: Model, block: int = BLOCK_CHARS) -> np.ndarray:
    """(text, language): how many phrases each text takes. Every ``block`` characters a new phrase
    begins, so that the blocks of all texts are parsed side by side."""
    codes, lengths = _classes_of(texts, model.classes)
    counts = -(-lengths // block)
    owner = np.repeat(np.arange(len(texts)), counts)
    inside = (np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)) * block
    size = np.minimum(lengths[owner] - inside, block)
    start = (np.cumsum(lengths) - lengths)[owner] + inside
    # Longest first: at each step the blocks that still have a character are the first ones.
    order = np.argsort(-size, kind="stable")
    start, size, owner = start[order], size[order], owner[order]
    n_languages = len(model.languages)
    root = model.roots[:, None]
    state = np.repeat(root, len(size), 1)
    total = np.zeros((n_languages, len(size)), np.int64)
    active = np.searchsorted(-size, -np.arange(1, (size[0] if len(size) else 0) + 1), "right")
    for i, n in enumerate(active.tolist()):
        c = codes[start[:n] + i]
        to = model.automata[state[:, :n], c]
        ended = to < 0
        # A phrase ends before this character, if it had begun; the next begins with it.
        total[:, :n] += ended & (state[:, :n] > root)
        to = np.where(ended, model.first[:, c], to)
        lacking = to < 0
        total[:, :n] += lacking
        state[:, :n] = np.where(lacking, root, to)
    total += state > root
    out = np.zeros((n_languages, len(texts)), np.int64)
    for k in range(n_languages):
        out[k] = np.bincount(owner, total[k], len(texts))
    return out.T


@cache
def letters() -> np.ndarray:
    """Of each code point: is it a letter?"""
    return np.array([chr(c).isalpha() for c in range(0x110000)])


@cache
def _marks() -> np.ndarray:
    """Of each code point: does it modify a letter, as a vowel sign does?"""
    return np.array([unicodedata.category(chr(c))[0] == "M" for c in range(0x110000)])


def backwards(texts: list[str], model: Model, need: np.ndarray) -> np.ndarray:
    """How many phrases each text takes from its end to its begin in its best language. ``need``: (text, language)."""
    best, out = need.argmin(1), np.zeros(len(texts), np.int64)
    for k in np.unique(best).tolist():
        at = np.flatnonzero(best == k)
        own = model._replace(languages=[model.languages[k]], first=model.first[k:k + 1], roots=model.roots[k:k + 1])
        out[at] = phrases([texts[i][::-1] for i in at], own)[:, 0]
    return out


def order_bounds(texts: dict[str, list[str]], model: Model) -> np.ndarray:
    """Per language the part of its phrases backwards that a text in it may take: two thirds of the way
    from the median of the given texts to one, so that labels that are wrong now and then don't
    matter. Infinite if no text of a language is long enough to tell."""
    bounds = np.full(len(model.languages), np.inf)
    for k, lang in enumerate(model.languages):
        if own := texts.get(lang):
            need = phrases(own, model)
            back = backwards(own, model, need)
            told = (need.argmin(1) == k) & (back >= FEWEST_BACKWARDS)
            if told.any():
                bounds[k] = (2 + np.median(need.min(1)[told] / back[told])) / 3
    return bounds


def _predict(model, keep_text):
    def predict(batches):
        is_letter, (m, bounds) = letters(), model.value
        names = np.array([*m.languages, UNKNOWN], object)
        for batch in bounded(batches, "text", 1024 * 1024):
            texts = plain_text(batch.column("text")).to_pylist()
            lengths = np.array([len(t) for t in texts])
            points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
            seen = np.concatenate([[0], np.cumsum(is_letter[points])])
            ends = np.cumsum(lengths)
            known = (seen[ends] > seen[ends - lengths]) & (len(m.languages) > 0)
            best, score = np.full(len(texts), len(m.languages)), np.zeros(len(texts))
            if known.any():
                lettered = [t for t, k in zip(texts, known) if k]
                need = phrases(lettered, m)
                rows = np.arange(len(need))
                first = need.argmin(1)
                best[known] = first
                least = need[rows, first]
                rest = need.copy()
                rest[rows, first] = np.iinfo(np.int64).max
                second = rest.min(1) if need.shape[1] > 1 else np.full(len(need), np.iinfo(np.int64).max)
                score[known] = 1 - least / (least + second.astype(float))
                if bounds is not None:
                    back = backwards(lettered, m, need)
                    strange = np.flatnonzero(known)[(back >= FEWEST_BACKWARDS) & (least > bounds[first] * back)]
                    best[strange], score[strange] = len(m.languages), 0
            columns = dict(zip(batch.schema.names, batch.columns))
            if not keep_text:
                del columns["text"]
            columns["lang_pred"], columns["score"] = pa.array(names[best], pa.string()), pa.array(score)
            yield pa.RecordBatch.from_arrays([*columns.values()], [*columns])
    return predict


def training_sample(labelled: DataFrame, sample_chars: int = SAMPLE_CHARS, document_chars: int = SAMPLE_DOCUMENT_CHARS) -> dict:
    """Pieces of documents per language, up to about ``sample_chars`` characters of each.

    ``labelled``: text and a language. Equal texts of a language count once. The documents of the
    least hashes are taken, as many as give ``sample_chars``, so equal tables give equal samples
    and a language with a text has one. Of a text of over ``document_chars`` that many characters
    are taken, in slices from its begin to its end. A pass hashes the texts; the hashes are
    written. The driver gets about two samples' worth of hashes, and each text taken once: at most
    ``sample_chars`` and one text's characters per language.
    """
    text = labelled.where(F.col("lang").isNotNull() & (F.trim("text") != "")).withColumn("hash", F.xxhash64("text"))
    chars = F.least(F.length("text"), F.lit(document_chars)).cast("long").alias("chars")
    keys = stage(text.select("lang", "hash", chars).groupBy("lang", "hash").agg(F.min("chars").alias("chars")), "text-hashes")
    held = {r["lang"]: r["chars"] for r in keys.groupBy("lang").agg(F.sum("chars").alias("chars")).collect()}
    share, found = {lang: min(1.0, 2 * sample_chars / n) for lang, n in held.items()}, {}
    while share:
        limits = [(lang, min(int(part * 2**64) - 2**63, 2**63 - 1)) for lang, part in share.items()]
        limits = F.broadcast(labelled.sparkSession.createDataFrame(limits, "lang string, most long"))
        near = {lang: [] for lang in share}
        for r in keys.join(limits, "lang").where("hash <= most").select("lang", "hash", "chars").collect():
            near[r["lang"]].append((r["hash"], r["chars"]))
        short = {lang for lang, rows in near.items() if share[lang] < 1 and sum(n for _, n in rows) < sample_chars}
        found |= {lang: sorted(rows) for lang, rows in near.items() if lang not in short}
        share = {lang: min(1.0, 2 * share[lang]) for lang in short}
    chosen = []
    for lang, rows in found.items():
        before = 0
        for hash_, n in rows:
            if before >= sample_chars:
                break
            chosen.append((lang, hash_))
            before += n
    if not chosen:
        return {}
    taken = F.broadcast(labelled.sparkSession.createDataFrame(chosen, "lang string, hash long"))
    rows = text.join(taken, ["lang", "hash"]).select("lang", "hash", _slices(F.col("text"), document_chars).alias("text"))
    out = {}
    for row in sorted(rows.groupBy("lang", "hash").agg(F.min("text").alias("text")).collect(), key=lambda r: (r["lang"], r["hash"])):
        out.setdefault(row["lang"], []).append(row["text"])
    return out


def _slices(text, chars: int):
    """The text, or of a longer one ``chars`` characters in slices at equal distances."""
    each = max(chars // SLICES, 1)
    starts = [((F.length(text) - each) * i / (SLICES - 1)).cast("int") + 1 for i in range(SLICES)]
    return F.when(F.length(text) <= chars, text).otherwise(F.concat_ws("\n", *[text.substr(at, F.lit(each)) for at in starts]))


def identify(docs: DataFrame, model: Model, keep_text: bool = False, bounds: np.ndarray | None = None) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, without its text unless it is to be kept.

    score: second-best phrases over those of the two best, from 0.5 (a tie, taken by the first
    name) to 1. A null text or one without a letter is ``und`` with score 0, as is every text if
    no language was learned and, given ``bounds``, one that takes more than that part of the phrases
    it takes backwards. A column of ``docs`` named lang_pred or score is replaced.
    """
    docs = docs.drop("lang_pred", "score").withColumn("text", F.col("text").cast("string"))
    shared = docs.sparkSession.sparkContext.broadcast((model, bounds))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if keep_text or f.name != "text")
    return arrow_map(docs, _predict(shared, keep_text), f"{kinds}{', ' if kinds else ''}lang_pred string, score double")


def fold(doc_id="doc_id"):
    """crc32 of the id as text, modulo 3."""
    return F.crc32(F.col(doc_id).cast("string")) % 3


def learn(docs: DataFrame, sample_chars: int = SAMPLE_CHARS) -> Model:
    """From the rows of ``docs`` with a language and outside fold 1; a null doc_id is in no fold and not used."""
    return train(training_sample(docs.where(fold() != 1).select("text", "lang"), sample_chars), sample_chars)


def learn_bounded(docs: DataFrame, sample_chars: int = SAMPLE_CHARS) -> tuple[Model, np.ndarray]:
    """Model and order bounds, each from half of the texts of a sample twice as large, of the same rows."""
    texts = training_sample(docs.where(fold() != 1).select("text", "lang"), 2 * sample_chars)
    model = train({lang: own[::2] for lang, own in texts.items()}, sample_chars)
    return model, order_bounds({lang: own[1::2] for lang, own in texts.items()}, model)


def predict_languages(docs: DataFrame, model: Model | None = None, sample_chars: int = SAMPLE_CHARS) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row of ``docs`` (doc_id, text, lang).

    Learned from the rows outside fold 1 unless a model is given. A null doc_id is not held out.
    Repeated rows are predicted alike; other columns are left out; no rows give none.
    """
    model = model or learn(docs, sample_chars)
    rows = docs.select("doc_id", F.coalesce(fold() == 1, F.lit(False)).alias("held_out"), "text")
    return identify(rows, model)


def keep_identified(
    docs: DataFrame, model: Model | None = None, accepted: list[str] | None = None, bounds: np.ndarray | None = None
) -> DataFrame:
    """The rows of ``docs`` in a language that was learned and, if languages are given, in one of them.

    Null texts go, those without a letter and, by the ``bounds`` learned unless a model is given, those whose
    letters are in no order that their best language has.
    """
    if model is None:
        model, bounds = learn_bounded(docs)
    inner, names = numbered_columns(docs)
    text = names["text"]
    judged = identify(inner.withColumnRenamed(text, "text"), model, True, bounds).withColumnRenamed("text", text)
    wanted = F.col("lang_pred") != UNKNOWN
    if accepted is not None:
        wanted &= F.col("lang_pred").isin(accepted)
    return named_columns(judged.where(wanted), names)
