"""Phrases whose words stand together more often than chance, the best of each language.

Phrases grow best first. The score of a phrase cut after its first word, or before its last one, is
at most 1000 n / f(word), as a phrase is no more frequent than its parts: rare words bound what they
begin or end the highest. A wave takes the words up to some frequency and grows all phrases that
begin or end with one, level by level, from those of the level before that are frequent enough.
The parts of a phrase with both ends in the wave, and what it is a part of by one word, have an end
there too, so its score is settled. The next wave takes the words whose bound still reaches
the score that the last phrase listed has so far; when no word is left, the list is final.

The corpus is written once as blocks of word numbers; a level is one pass over it.
"""

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillmart.llm.blocks import arrow_map, bounded, give_back, plain_text
from tillmart.workspace import stage

LEAST, TOP, LONGEST = 100, 2000, 5
UNKNOWN = "und"
#: part of all frequent words' places that the first wave's words, the rarest, may take
FIRST_WAVE = 0.5
BLOCK_BYTES = 4 * 1024 * 1024
BROADCAST_BYTES = 32 * 1024 * 1024
_PENDING = 4_000_000
_LEAST_BITS, _MOST_BITS = 16, 27
_KEYS = ["k1", "k2", "k3"]
_LOW = (1 << 32) - 1

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_BREAKS = b".,;:!?\n\x0b\x0c\r"
_KIND = np.zeros(256, np.uint8)
_KIND[[9, 32]] = 1
_KIND[[*_BREAKS]] = 2
_BREAK = re.compile(b"[" + re.escape(_BREAKS) + b"]")


def _numbers(bound: int) -> str:
    return "<u2" if bound <= 1 << 16 else "<u4"


def _parts(raw: bytes, size: int):
    """Cut behind breaks, where no phrase goes on; longer only where there is none."""
    begin = 0
    while begin < len(raw):
        cut = _BREAK.search(raw, begin + size)
        end = cut.end() if cut else len(raw)
        yield raw[begin:end]
        begin = end


def words_of(raw: bytes) -> tuple[pa.Array, np.ndarray]:
    """The distinct words of a text, and its words as their numbers from 1; a 0 at each break between two words."""
    data = np.frombuffer(raw.translate(_LOWER), np.uint8)
    kind = _KIND[data]
    word = kind == 0
    edge = np.flatnonzero(np.diff(word.astype(np.int8), prepend=0, append=0))
    start, end = edge[::2], edge[1::2]
    breaks = np.concatenate([[0], np.cumsum(kind == 2, dtype=np.int32)])
    apart = np.zeros(len(start), bool)
    apart[1:] = breaks[start[1:]] != breaks[end[:-1]]
    offsets = np.concatenate([[0], np.cumsum(end - start)])
    letters = pa.py_buffer(data[word].tobytes())
    found = pa.Array.from_buffers(pa.large_string(), len(start), [None, pa.py_buffer(offsets), letters]).dictionary_encode()
    codes = np.zeros(len(start) + int(apart.sum()), np.int64)
    codes[np.arange(len(start)) + np.cumsum(apart)] = found.indices.to_numpy() + 1
    return found.dictionary, codes


def _word_blocks(batches):
    number = TaskContext.get().partitionId() << 32
    for batch in bounded(batches, "text", BLOCK_BYTES):
        texts, of_lang = plain_text(batch.column("text")), {}
        for i, lang in enumerate(batch.column("lang").to_pylist()):
            of_lang.setdefault(lang, []).append(i)
        for lang, rows in of_lang.items():
            raw = "\n".join(texts.take(pa.array(rows)).to_pylist()).encode()
            for part in _parts(raw, BLOCK_BYTES):
                words, codes = words_of(part)
                if not len(words):
                    continue
                yield pa.RecordBatch.from_arrays([
                    pa.array([number], pa.int64()), pa.array([lang], pa.string()), pa.array([words.to_pylist()], pa.list_(pa.string())),
                    pa.array([np.bincount(codes, minlength=len(words) + 1)[1:]], pa.list_(pa.int64())),
                    pa.array([codes.astype(_numbers(len(words) + 1)).tobytes()], pa.binary()),
                ], ["block", "lang", "words", "times", "codes"])
                number += 1
        give_back()


def word_blocks(docs: DataFrame) -> DataFrame:
    """Blocks of one language each, written: its words and how often each stands there, and the text in their numbers."""
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col("text").cast("string").alias("text"))
    return stage(arrow_map(rows, _word_blocks, "block long, lang string, words array<string>, times array<long>, codes binary"), "word-blocks")


def frequent_words(counts: DataFrame, least: int) -> DataFrame:
    """lang, word, f and id, 1 to the number of rows, of the words that stand ``least`` times or more."""
    rows = counts.where(F.col("f") >= least)
    rows = stage(rows.select("lang", "word", "f", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")), "frequent-words")
    before, offsets = 0, []
    for part, n in sorted((r["part"], r["n"]) for r in rows.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()):
        offsets.append((part, before))
        before += n
    if before > _LOW:
        raise ValueError(f"{before} frequent words are more than phrases have numbers for")
    offsets = rows.sparkSession.createDataFrame(offsets, "part int, before long")
    id_ = (F.col("before") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1)) + 1).alias("id")
    return stage(rows.join(F.broadcast(offsets), "part").select("lang", "word", "f", id_), "word-ids")


def _recoded(lang, n_words, codes, at, ids, f):
    """A block in the numbers 1, 2, ... of its words ``at``, whose ids and frequencies are given."""
    new = np.zeros(n_words + 1, np.int64)
    new[at + 1] = np.arange(1, len(at) + 1)
    codes = new[np.frombuffer(codes, _numbers(n_words + 1))]
    # Of breaks in a row, and words with a break on both sides, one break is left.
    padded = np.concatenate([[0], codes, [0]]) > 0
    codes = np.where(padded[:-2] | padded[2:], codes, 0)
    codes = codes[(codes > 0) | np.concatenate([[False], codes[:-1] > 0])]
    columns = [np.concatenate([[0], x]).astype(kind) for x, kind in ((ids, "<u4"), (f, "<i8"))]
    columns.append(codes.astype(_numbers(len(ids) + 1)))
    return pa.RecordBatch.from_arrays(
        [pa.array([lang]), *(pa.array([x.tobytes()], pa.binary()) for x in columns)], ["lang", "ids", "f", "codes"])


def _renumber(batches):
    """Blocks that bring what is known of their words."""
    for batch in batches:
        known = batch.column("known")
        ends = known.offsets.to_numpy()
        of_word = [known.values.field(name).to_numpy() for name in ("at", "id", "f")]
        sizes, langs, codes = batch.column("n_words").to_pylist(), batch.column("lang").to_pylist(), batch.column("codes")
        for i, (begin, end) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist())):
            yield _recoded(langs[i], sizes[i], codes[i].as_buffer(), *(x[begin:end] for x in of_word))
        give_back()


def _look_up(shared):
    """shared: language -> (frequent words, their ids and frequencies)"""
    def look_up(batches):
        for batch in batches:
            langs, words, codes = batch.column("lang").to_pylist(), batch.column("words"), batch.column("codes")
            for i, lang in enumerate(langs):
                if lang in shared.value:
                    frequent, ids, f = shared.value[lang]
                    own = words[i].values.cast(frequent.type)
                    found = pc.index_in(own, value_set=frequent).fill_null(-1).to_numpy()
                    at = np.flatnonzero(found >= 0)
                    yield _recoded(lang, len(own), codes[i].as_buffer(), at, ids[found[at]], f[found[at]])
            give_back()
    return look_up


def number_words(blocks: DataFrame, words: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """The blocks in numbers of frequent words, written; other words are breaks, as no phrase holds one.

    Up to ``broadcast_bytes`` of frequent words go to all tasks; beyond that the words of each block are joined with them.
    """
    schema = "lang string, ids binary, f binary, codes binary"
    size = words.agg(F.sum(F.octet_length("word") + F.octet_length("lang") + 32)).first()[0] or 0
    if size <= broadcast_bytes:
        table, of_lang = words.select("lang", "word", "id", "f").toArrow().combine_chunks(), {}
        for lang in table.column("lang").unique().to_pylist():
            own = table.filter(pc.equal(table.column("lang"), lang)).combine_chunks()
            word = own.column("word").combine_chunks()
            of_lang[lang] = (word, own.column("id").to_numpy(), own.column("f").to_numpy())
        shared = blocks.sparkSession.sparkContext.broadcast(of_lang)
        return stage(arrow_map(blocks.select("lang", "words", "codes"), _look_up(shared), schema), "numbered-blocks")
    seen = blocks.select("block", "lang", F.posexplode("words").alias("at", "word")).join(words, ["lang", "word"])
    known = seen.groupBy("block").agg(F.collect_list(F.struct("at", "id", "f")).alias("known"))
    rows = blocks.select("block", "lang", F.size("words").alias("n_words"), "codes").join(known, "block").drop("block")
    return stage(arrow_map(rows, _renumber, schema), "numbered-blocks")


def _places(parts: list[np.ndarray], bits: int) -> np.ndarray:
    """Of phrases, given as the ids of their first words, of their second ones, ...: places in a table of 2^bits bits."""
    code = np.zeros(len(parts[0]), np.uint64)
    for ids in parts:
        code = (code ^ ids.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        code ^= code >> np.uint64(29)
    return (code * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - bits)


def _mark(length, bits):
    def mark(batches):
        for batch in batches:
            keys = [batch.column(k).to_numpy() for k in _KEYS]
            place = _places([(keys[i // 2] >> 32 if i % 2 == 0 else keys[i // 2] & _LOW) for i in range(length)], bits)
            at, inverse = np.unique(place >> np.uint64(6), return_inverse=True)
            held = np.zeros(len(at), np.uint64)
            np.bitwise_or.at(held, inverse, np.uint64(1) << (place & np.uint64(63)))
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int64)), pa.array(held.view(np.int64))], ["at", "held"])
    return mark


def phrase_filter(phrases: DataFrame, length: int) -> tuple[int, np.ndarray]:
    """(bits, table): a bit set for each phrase, at most 16 MB whatever their number. A phrase without its bit isn't there."""
    n = phrases.count()
    bits = min(max((16 * n).bit_length(), _LEAST_BITS), _MOST_BITS)
    marks = arrow_map(phrases.select(*_KEYS), _mark(length, bits), "at long, held long").groupBy("at").agg(F.bit_or("held").alias("held")).toArrow()
    table = np.zeros(1 << bits - 6, np.uint64)
    table[marks.column("at").to_numpy()] = marks.column("held").to_numpy().view(np.uint64)
    return bits, table


def _pack(parts):
    """As many keys as it takes, with two ids each; none is 0."""
    return [parts[i] << 32 | (parts[i + 1] if i + 1 < len(parts) else 0) for i in range(0, len(parts), 2)]


def _windows(shared, length):
    def count(batches):
        done, upto, known = shared.value
        pending, held = [], 0

        def counted():
            keys = [np.concatenate(k) for k in zip(*pending)]
            if length == 2:
                *keys, n = np.unique(keys[0], return_counts=True)
            else:
                order = np.lexsort(keys)
                keys = [k[order] for k in keys]
                new = np.ones(len(order), bool)
                new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
                begin = np.flatnonzero(new)
                n = np.diff(np.append(begin, len(order)))
                keys = [k[begin] for k in keys]
            return pa.RecordBatch.from_arrays([*map(pa.array, keys), pa.array(n)], [*_KEYS[:len(keys)], "n"])

        for batch in batches:
            for r in batch.to_pylist():
                if r["lang"] not in upto:
                    continue
                ids, f = np.frombuffer(r["ids"], "<u4").astype(np.int64), np.frombuffer(r["f"], "<i8")
                codes = np.frombuffer(r["codes"], _numbers(len(ids))).astype(np.int64)
                n = len(codes) - length + 1
                if n <= 0:
                    continue
                inside = codes > 0
                ok = inside[:n].copy()
                for i in range(1, length):
                    ok &= inside[i:i + n]
                at = np.flatnonzero(ok)
                first, last = f[codes[at]], f[codes[at + length - 1]]
                rarer = np.minimum(first, last)
                keep = (rarer > done.get(r["lang"], 0)) & (rarer <= upto[r["lang"]])
                at, first, last = at[keep], first[keep], last[keep]
                parts = [ids[codes[at + i]] for i in range(length)]
                if known is not None and len(at):
                    bits, table = known
                    keep = np.ones(len(at), bool)
                    for ends, part in ((first, parts[:-1]), (last, parts[1:])):
                        place = _places(part, bits)
                        frequent = (table[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) > 0
                        keep &= frequent | (ends > upto[r["lang"]])
                    parts = [p[keep] for p in parts]
                if len(parts[0]):
                    pending.append(_pack(parts))
                    held += len(parts[0])
                if held > _PENDING:
                    yield counted()
                    pending, held = [], 0
        if pending:
            yield counted()
        pending = []
        give_back()
    return count


def count_phrases(blocks: DataFrame, words: DataFrame, length: int, done: dict, upto: dict, known, least: int) -> DataFrame:
    """Phrases of ``length`` words whose rarer end stands over ``done`` and up to ``upto`` times, written; those that stand ``least`` times."""
    shared = blocks.sparkSession.sparkContext.broadcast((done, upto, known))
    keys = _KEYS[:(length + 1) // 2]
    found = arrow_map(blocks, _windows(shared, length), ", ".join(f"{k} long" for k in [*keys, "n"]))
    found = found.groupBy(*keys).agg(F.sum("n").alias("a")).where(F.col("a") >= least)
    found = found.withColumns({k: F.lit(0).cast("long") for k in _KEYS if k not in keys})
    last = F.col(_KEYS[(length - 1) // 2])
    last = F.shiftright(last, 32) if length % 2 else last.bitwiseAND(F.lit(_LOW))
    found = found.withColumn("first_id", F.shiftright("k1", 32)).withColumn("last_id", last)
    found = found.join(words.select("lang", F.col("id").alias("first_id"), F.col("f").alias("first_f")), "first_id")
    found = found.join(words.select(F.col("id").alias("last_id"), F.col("f").alias("last_f")), "last_id")
    return stage(found.select(*_KEYS, F.lit(length).alias("length"), "a", "lang", "first_f", "last_f"), f"phrases-of-{length}")


def _ids():
    """The ids of a phrase's words, zeros after the last."""
    return F.array(*[x for k in _KEYS for x in (F.shiftright(k, 32), F.col(k).bitwiseAND(F.lit(_LOW)))])


def _key(ids, names):
    at = lambda i: F.coalesce(F.get(ids, F.lit(i)), F.lit(0).cast("long"))
    return [(F.shiftleft(at(i), 32).bitwiseOR(at(i + 1))).alias(name) for i, name in zip((0, 2, 4), names)]


def settle(phrases: DataFrame, words: DataFrame, totals: DataFrame, upto: DataFrame) -> DataFrame:
    """lang, keys, a, l, r, n and score of the phrases with both ends in a wave that no longer one of equal frequency holds."""
    sized = phrases.select(*_KEYS, F.col("a").alias("f")).unionByName(
        words.select(F.shiftleft("id", 32).alias("k1"), F.lit(0).cast("long").alias("k2"), F.lit(0).cast("long").alias("k3"), "f"))
    longer = phrases.where("length > 2").withColumn("ids", _ids())
    part = lambda begin: F.struct(*_key(F.slice("ids", F.lit(begin), F.col("length") - 1), _KEYS))
    held = longer.select("a", F.explode(F.array(part(1), part(2))).alias("p")).groupBy("p").agg(F.max("a").alias("longer"))
    held = held.select("p.*", "longer")
    ready = phrases.join(upto, "lang").where("first_f <= upto and last_f <= upto").join(held, _KEYS, "left")
    ready = ready.where("longer is null or longer < a").join(totals, "lang").withColumn("ids", _ids())
    cuts = ready.select(*_KEYS, "lang", "a", "n", "ids", "length", F.explode(F.sequence(F.lit(1), F.col("length") - 1)).alias("cut"))
    left, right = [f"l{k}" for k in _KEYS], [f"r{k}" for k in _KEYS]
    cuts = cuts.select(
        *_KEYS, "lang", "a", "n", "cut", *_key(F.slice("ids", F.lit(1), F.col("cut")), left),
        *_key(F.slice("ids", F.col("cut") + 1, F.col("length") - F.col("cut")), right),
    )
    for side, name in ((left, "l"), (right, "r")):
        cuts = cuts.join(sized.select(*[F.col(k).alias(s) for k, s in zip(_KEYS, side)], F.col("f").alias(name)), side)
    wide = [f"cast({c} as decimal(19, 0))" for c in ("a", "n", "l", "r")]
    score = F.expr(f"(cast(1000 as decimal(4, 0)) * ({wide[0]} * {wide[1]})) div ({wide[2]} * {wide[3]})")
    least = F.min(F.struct(score.alias("score"), "cut", "l", "r"))
    return cuts.groupBy(*_KEYS, "lang", "a", "n").agg(least.alias("x")).select(*_KEYS, "lang", "a", "n", "x.l", "x.r", "x.score")


def _first_wave(words: DataFrame, share: float) -> dict:
    """Per language the frequency up to which words take ``share`` of all frequent words' places, a power of two less one."""
    rows = words.groupBy("lang", F.length(F.bin("f")).alias("bits")).agg(F.sum("f").alias("places")).collect()
    out = {}
    for lang in {r["lang"] for r in rows}:
        own = sorted((r["bits"], r["places"]) for r in rows if r["lang"] == lang)
        total, before = sum(n for _, n in own), 0
        out[lang] = (1 << own[0][0]) - 1
        for bits, n in own:
            before += n
            if before <= share * total:
                out[lang] = (1 << bits) - 1
    return out


def collocations(
    docs: DataFrame, top: int = TOP, least: int = LEAST, longest: int = LONGEST, first_wave: float = FIRST_WAVE
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score: each language's ``top`` phrases of 2 to ``longest`` (at most 6) words.

    ``docs``: lang (null: ``und``) and text (null: empty). A-Z count as a-z; words are what blanks
    and tabs part in the pieces between ``.,;:!?`` and line ends. n: words of the language;
    a: how often the phrase stands in its pieces, ``least`` times or more; l and r: how often the
    two sides of its lowest-scoring cut do, the shortest left side of several; score: floor(1000 a n
    / (l r)), exact. A phrase that a longer one of up to ``longest`` words holds and that stands as
    often is left out. Order: score, a, then the phrase's bytes. Repeated rows count each time;
    other columns are left out; no rows give none.

    The driver gets a row per language with a frequent word, and a filter of at most 16 MB per level.
    """
    blocks = word_blocks(docs)
    counts = blocks.select("lang", F.explode(F.arrays_zip("words", "times")).alias("x")).groupBy("lang", F.col("x.words").alias("word"))
    counts = stage(counts.agg(F.sum("x.times").alias("f")), "word-counts")
    totals = stage(counts.groupBy("lang").agg(F.sum("f").alias("n")), "words-of-languages")
    words = frequent_words(counts, least)
    numbered = number_words(blocks, words)
    most = {r["lang"]: r["f"] for r in words.groupBy("lang").agg(F.max("f").alias("f")).collect()}
    n = {r["lang"]: r["n"] for r in totals.join(words.select("lang").distinct(), "lang", "left_semi").collect()}
    spark, upto, done, of_length = docs.sparkSession, _first_wave(words, first_wave), {}, {}
    found = None
    while True:
        growing = {lang: f for lang, f in upto.items() if f > done.get(lang, 0)}
        if not growing and found is not None:
            break
        known = None
        for length in range(2, longest + 1):
            part = count_phrases(numbered, words, length, done, growing, known, least)
            of_length[length] = part if length not in of_length else of_length[length].unionByName(part)
            known = phrase_filter(of_length[length], length) if length < longest else None
        phrases = of_length[2]
        for length in range(3, longest + 1):
            phrases = phrases.unionByName(of_length[length])
        done = done | growing
        waves = spark.createDataFrame([(lang, f) for lang, f in done.items()], "lang string, upto long")
        found = stage(settle(phrases, words, totals, waves), "settled-phrases")
        order = Window.partitionBy("lang").orderBy(F.desc("score"))
        last = found.select("lang", "score", F.row_number().over(order).alias("rank")).where(F.col("rank") <= top).where(F.col("rank") == top).collect()
        to_reach = {r["lang"]: r["score"] for r in last}
        # A word beyond this frequency bounds what it begins or ends below the score to reach.
        upto = {lang: min(f, 1000 * n[lang] // to_reach[lang]) if to_reach.get(lang) else f for lang, f in most.items()}
    reach = spark.createDataFrame([*to_reach.items()], "lang string, least_score long")
    best = found.join(reach, "lang", "left").where("least_score is null or score >= least_score").withColumn("ids", _ids())
    spelled = best.select(*_KEYS, F.posexplode("ids").alias("at", "id")).where("id > 0").join(words.select("id", "word"), "id")
    spelled = spelled.groupBy(*_KEYS).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ").alias("phrase"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = best.join(spelled, _KEYS).withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
