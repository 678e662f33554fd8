"""Fuzzy line deduplication: SimHash blocks of the words, edit similarity, connected groups.

A line is normalised to its words: ASCII lower case, digits as 0, every other
ASCII character that is no letter parts words. Equal normalised lines (128-bit
hash) form one class. Lines of fewer than ``MIN_WORDS`` words and ``MIN_CHARS``
characters are always kept.

The SimHash of a line is laid out in blocks for the pigeonhole: a line's
distinct words are dealt into groups by their hash, about ``GROUP_WORDS`` a group, and
the 64 bits of a block are voted on by the words of its group alone. A changed
word touches the blocks of its old and its new form only, so two lines that
differ in fewer such forms than they have blocks share a block, and most that
differ in more share one as well. The number of groups is the power of two next
to words / ``GROUP_WORDS``; lines within ``EDGE`` of the next one (in powers)
have the blocks of both. It depends on the line alone, not on the corpus. Lines
of fewer than ``MIN_WORDS`` words also have a block of all their words and one
of all but each, so those that differ in one word share a block.

Two lines are linked if they share a block, their whole SimHashes (128 bits,
all words voting) differ in at most ``MAX_BITS`` bits, and the edit similarity
(1 - edit distance / longer length) of the normalised lines is at least
``percent`` %. This holds in buckets of every size: all their members' bits are
compared, in tiles of ``TILE``, and the pairs that are near enough are listed.
Where a unit has more than ``COMMON`` of them a member, its groups go by stars
first and then in full (see ``components.bucket_components``). Of each connected
group of lines the first occurrence, by id and line number, is kept and the
others are cut out of their documents.

Defined results: a null text stays null and has no lines; rows that share id
and text are one row in this respect, and lose the same lines; a null id comes
before others; an empty table gives an empty result; the other columns pass
through untouched.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from ..session import work_dir
from .components import _chunk_forest, bucket_components, connected_components
from .shared import BLOOM, arrow_map, bound_batches, join_few, let, settings, written
from .text import BLANK, CONTINUATION, Texts, lists, mix, one_of_each, signed, span_hashes, text_slices

MIN_WORDS = 5
MIN_CHARS = 6
PERCENT = 80
GROUP_WORDS = 6
EDGE = 0.1
FEW_WORDS = 8
MAX_BITS = 32
COMMON = 64
TILE = 8192  # lines of a larger bucket that are compared with as many others as one unit of work
_UNIT_ROWS = 64  # lines of a unit compared at a time with all others
_UNIT_COLUMNS = ["bucket", "low", "high", "tile", "node", "s1", "s2", "size"]
_HELD_ROWS = 1 << 16  # rows of units held at a time, and those of one unit
_STEP_WORDS = 1 << 18  # words whose bits are summed at a time
_FEW = np.uint64(0x5EED0FFE3D0B10C5)  # sets the blocks of few words apart from others
_ROWS = {"spark.sql.execution.arrow.maxRecordsPerBatch": "16384"}  # of a few numbers each

_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[65:91] += 32
_PLAIN[48:58] = 48
_PLAIN[[c for c in range(128) if not chr(c).isalnum()]] = 32


def _line_words(texts: Texts):
    """Starts and ends of lines and of normalised words, the line of each word, and the normalised bytes."""
    begin, end = texts.line_spans()
    plain = Texts(_PLAIN[texts.data], texts.offsets)
    # line breaks have become blanks, so no word crosses a line
    starts, ends = plain.word_spans()
    filled = np.flatnonzero(end > begin)
    line = filled[np.searchsorted(begin[filled], starts, "right") - 1] if len(starts) else np.zeros(0, np.int64)
    return begin, end, starts, ends, line, plain.data


# byte -> its eight bits, highest first, each in a byte of its own: sums of up to 255 such numbers keep the bytes apart
_SPREAD = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).reshape(-1).view(np.uint64)
_LANE = 255


def simhash(words: np.ndarray, count: np.ndarray, parts_of_64: int = 2) -> list[np.ndarray]:
    """64-bit parts for each run of ``count`` words; the runs lie side by side and are not empty.

    A bit is set if more than half of the words' hashes have it.
    """
    first = np.cumsum(count) - count
    parts = -(-count // _LANE)  # each run in parts that a lane can count
    of_part = np.repeat(np.arange(len(count)), parts)
    step = np.arange(len(of_part)) - np.repeat(np.cumsum(parts) - parts, parts)
    starts = first[of_part] + step * _LANE
    per_run = np.cumsum(parts) - parts
    one, half = parts == 1, (count // 2)[:, None]
    halves = []
    for salt in (np.uint64(0), np.uint64(0xA5A5A5A5DEADBEEF))[:parts_of_64]:
        lanes = np.zeros((len(starts), 8), np.uint64)
        at = 0
        while at < len(starts):  # a bounded number of words at a time
            to = max(at + 1, int(np.searchsorted(starts, starts[at] + _STEP_WORDS)))
            end = starts[to] if to < len(starts) else len(words)
            own = mix(words[starts[at]: end] ^ salt).astype(">u8").view(np.uint8).reshape(-1, 8)
            edges = np.r_[starts[at:to], end] - starts[at]
            total = np.zeros(len(own) + 1, np.uint64)
            for k in range(8):  # running totals wrap round, their differences are the sums all the same
                np.cumsum(_SPREAD[own[:, k]], out=total[1:])
                lanes[at:to, k] = np.diff(total[edges])
            at = to
        sums = lanes.view(np.uint8).reshape(-1, 64)
        if one.all():
            bits = sums > half.astype(np.uint8)
        else:
            bits = np.add.reduceat(sums.astype(np.int64), per_run, axis=0) > half
        halves.append(np.packbits(bits, axis=1).view(">u8").reshape(-1).astype(np.uint64))
    return halves


def distinct_words(words: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each line's words once: a word that stands often would outvote the others."""
    every, which = np.unique(words, return_inverse=True)
    keys = np.repeat(np.arange(len(count)) * len(every), count) + which  # by line, then by word
    keys.sort()
    keys = keys[np.r_[len(keys) > 0, keys[1:] != keys[:-1]]] if len(keys) else keys
    line, which = np.divmod(keys, max(len(every), 1))
    return every[which], np.bincount(line, minlength=len(count))


def block_keys(words: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The block keys of lines of ``count`` distinct words side by side, and the line of each."""
    power = np.log2(np.maximum(count, 1) / GROUP_WORDS)
    least = np.where(count < FEW_WORDS, 1, 2)
    low, high = (np.maximum(np.rint(power + d), least).astype(np.int64) for d in (-EDGE, EDGE))
    mixed, line = mix(words), np.repeat(np.arange(len(count)), count)
    keys, lines_of = [], []
    for powers, own in ((low, np.ones(len(count), bool)), (high, high != low)):
        some = np.flatnonzero(own[line])
        group = ((mixed[some] >> np.uint64(24)) & ((np.uint64(1) << powers[line[some]].astype(np.uint64)) - np.uint64(1))).astype(np.int64)
        order = np.argsort(line[some] << 32 | group)  # a group's words in any order
        of, group = line[some][order], group[order]
        first = np.flatnonzero(np.r_[len(of) > 0, (of[1:] != of[:-1]) | (group[1:] != group[:-1])])
        bits = simhash(words[some][order], np.diff(np.r_[first, len(of)]), 1)[0] if len(first) else words[:0]
        name = (powers[of[first]] << 32 | group[first]).astype(np.uint64)
        keys.append(mix(bits ^ mix(name)))
        lines_of.append(of[first])
    return np.concatenate(keys), np.concatenate(lines_of)


def few_word_keys(words: np.ndarray, count: np.ndarray, few: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For the lines ``few``: a block key of all their distinct words, and one of all but each; and the line of each key."""
    own = np.repeat(few, count)
    mixed = mix(words[own])
    lines, n = np.flatnonzero(few), count[few]
    every = np.add.reduceat(mixed, np.cumsum(n) - n) if len(n) else mixed  # in any order
    left = np.repeat(every, n) - mixed
    several = np.repeat(n > 1, n)
    keys = mix(np.r_[every, left[several]] ^ _FEW)
    return keys, np.r_[lines, np.repeat(np.arange(len(count)), count)[own][several]]


def _line_hashes(words: np.ndarray, n: np.ndarray) -> list[np.ndarray]:
    """Two 64-bit hashes of each run of ``n`` words, in order."""
    first = np.cumsum(n) - n
    place = (np.arange(len(words)) - np.repeat(first, n)).astype(np.uint64)
    return [np.add.reduceat(mix(words ^ mix(place + s)), first) + n.astype(np.uint64) if len(n) else words
            for s in (np.uint64(1), np.uint64(1 << 40))]


_LINE, _CLASS = 0, 1  # a row for each line; a row for each distinct line of a slice of texts, with its blocks


def _lines(schema: pa.Schema):
    def rows(values: dict) -> pa.RecordBatch:
        n = len(next(iter(values.values())))
        return pa.RecordBatch.from_arrays([values[f.name] if f.name in values else pa.nulls(n, f.type) for f in schema], schema=schema)

    def run(batches):
        for part, texts in text_slices(batches):
            begin, _, starts, ends, line, plain = _line_words(texts)
            count = np.bincount(line, minlength=len(begin))
            per_row = np.bincount(texts.row_of(np.flatnonzero(texts.data == 10)), minlength=texts.rows) + 1
            row = np.repeat(np.arange(texts.rows), per_row)
            number = np.arange(len(begin)) - np.repeat(np.cumsum(per_row) - per_row, per_row)
            own = np.flatnonzero(count)
            n = count[own]
            letters = np.cumsum(np.r_[0, ~CONTINUATION[plain]])
            size = np.add.reduceat(letters[ends] - letters[starts], np.cumsum(n) - n) + n - 1 if len(own) else n
            kept = (n >= MIN_WORDS) | (size >= MIN_CHARS)
            words = np.repeat(kept, n)
            own, n, size = own[kept], n[kept], size[kept]
            words = span_hashes(plain, starts[words], ends[words])
            h1, h2 = _line_hashes(words, n)
            take = pa.array(row[own])
            yield rows({"doc_id": part.column("doc_id").take(take), "text_hash": part.column("text_hash").take(take),
                        "line_no": pa.array(number[own].astype(np.int32)), "h1": pa.array(signed(h1)), "h2": pa.array(signed(h2)),
                        "kind": pa.array(np.full(len(own), _LINE, np.int32))})
            once = np.zeros(len(own), bool)
            once[one_of_each(h1)] = True
            words, n, h1, size = words[np.repeat(once, n)], n[once], h1[once], size[once]
            if not len(n):
                continue
            few = n < MIN_WORDS
            words, n = distinct_words(words, n)
            keys, of = (np.concatenate(x) for x in zip(block_keys(words, n), few_word_keys(words, n, few)))
            order = np.argsort(of, kind="stable")
            s1, s2 = simhash(words, n)
            yield rows({"h1": pa.array(signed(h1)), "s1": pa.array(signed(s1)), "s2": pa.array(signed(s2)),
                        "size": pa.array(size.astype(np.int32)),
                        "blocks": lists(pa.array(signed(keys[order])), np.bincount(of, minlength=len(n))),
                        "kind": pa.array(np.full(len(n), _CLASS, np.int32))})
    return run


def _line_texts(batches):
    """The wanted lines alone, as texts of their own."""
    for part, texts in text_slices(batches):
        begin, end = texts.line_spans()
        per_row = np.bincount(texts.row_of(np.flatnonzero(texts.data == 10)), minlength=texts.rows) + 1
        first_line = (np.cumsum(per_row) - per_row).tolist()
        found = [(x["h1"], first_line[r] + x["line_no"]) for r, wanted in enumerate(part.column("wanted").to_pylist()) for x in wanted]
        at = np.array([i for _, i in found], np.int64)
        plain = Texts(_PLAIN[np.concatenate([texts.data[:0], *(texts.data[b:e] for b, e in zip(begin[at].tolist(), end[at].tolist()))])],
                      np.r_[0, np.cumsum(end[at] - begin[at])])
        starts, ends = plain.word_spans()
        line = plain.row_of(starts)
        kept = ~BLANK[plain.data]
        kept[starts[1:][line[1:] == line[:-1]] - 1] = True  # one blank before each but the first word of a line
        raw, cuts = plain.data[kept].tobytes(), np.r_[0, np.cumsum(plain.per_row(kept))].tolist()
        sims = simhash(*distinct_words(span_hashes(plain.data, starts, ends), np.bincount(line, minlength=len(found))))
        yield pa.RecordBatch.from_arrays([pa.array([h for h, _ in found], pa.int64()),
                                          pa.array([raw[a:b].decode("utf-8", "replace") for a, b in zip(cuts, cuts[1:])], pa.string()),
                                          *(pa.array(signed(x)) for x in sims)], names=["node", "line", "s1", "s2"])


def _near(x, y):
    """Whether the whole SimHashes (s1, s2) of two lines differ in at most MAX_BITS bits."""
    return F.bit_count(x["s1"].bitwiseXOR(y["s1"])) + F.bit_count(x["s2"].bitwiseXOR(y["s2"])) <= MAX_BITS


def _shared_rows(batches):
    """Of rows sorted by bucket: those whose bucket has several nodes, once in a batch, with their tile of ``TILE`` rows.

    A bucket that goes on in the next batch may name a node twice.
    """
    bucket, node, place = np.zeros(0, np.int64), np.zeros(0, np.int64), 0  # the last row, held back, and its place in its bucket

    def rows(bucket, node, place):
        return pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(node), pa.array((place // TILE).astype(np.int32))],
                                          names=["bucket", "node", "tile"])

    for batch in batches:
        bucket = np.r_[bucket, batch.column("bucket").to_numpy()]
        node = np.r_[node, batch.column("node").to_numpy()]
        if not len(bucket):
            continue
        held = 1 if place else 0  # a bucket's rows in order of their nodes, but for the one that has its place
        order = np.r_[np.arange(held), held + np.lexsort((node[held:], bucket[held:]))]
        bucket, node = bucket[order], node[order]
        new = np.r_[True, (bucket[1:] != bucket[:-1]) | (node[1:] != node[:-1])]
        bucket, node = bucket[new], node[new]
        first = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
        places = np.arange(len(bucket)) - np.repeat(first, np.diff(np.r_[first, len(bucket)]))
        places[: first[1] if len(first) > 1 else len(bucket)] += place
        several = (places[:-1] > 0) | (places[1:] > 0)
        yield rows(bucket[:-1][several], node[:-1][several], places[:-1][several])
        bucket, node, place = bucket[-1:], node[-1:], int(places[-1])
    if place:
        yield rows(bucket, node, np.array([place]))


def _near_rows(s1, s2, size, i, j, percent: int) -> np.ndarray:
    """Whether the whole SimHashes of rows i and j differ in at most MAX_BITS bits, and their lengths allow a link."""
    x, y = size[i], size[j]
    return (np.bitwise_count(s1[i] ^ s1[j]) + np.bitwise_count(s2[i] ^ s2[j]) <= MAX_BITS) & (
        100 * np.minimum(x, y) >= percent * np.maximum(x, y))


def _unit_pairs(s1, s2, size, tile, percent: int):
    """Batches of near pairs (i, j) of one large unit: within its tile, or between its two."""
    order = np.argsort(size, kind="stable")
    s1, s2, size, tile = s1[order], s2[order], size[order], tile[order]
    two, at = tile.min() != tile.max(), 0
    while at < len(size):
        to = min(len(size), at + _UNIT_ROWS)
        top = int(np.searchsorted(size, size[to - 1] * 100 // percent, "right"))  # longer lines are too long for these
        i, j = np.arange(at, to)[:, None], np.arange(at, top)[None, :]
        near = _near_rows(s1, s2, size, i, j, percent) & (i < j)
        if two:
            near &= tile[i] != tile[j]
        i, j = np.nonzero(near)
        if len(i):
            yield order[i + at], order[j + at]
        at = to


def _near_units(percent: int):
    """Rows come sorted by unit. Of each unit the near pairs (a, b), or, if they are very many, their groups as buckets.

    No pair of different groups is near, so a group is a bucket of its own,
    with its number of members. A bounded number of rows is held at a time.
    """
    def compared(table: pa.Table) -> pa.RecordBatch:
        bucket, low, high, tile, node, s1, s2, size = (table.column(x).to_numpy() for x in _UNIT_COLUMNS)
        s1, s2, size = s1.view(np.uint64), s2.view(np.uint64), size.astype(np.int64)
        first = np.flatnonzero(np.r_[True, (bucket[1:] != bucket[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])])
        n = np.diff(np.r_[first, len(bucket)])
        small = (n <= COMMON) & (low[first] == high[first])
        a, b, groups, members, counts = [], [], [], [], []
        row, end = np.flatnonzero(np.repeat(small, n)), np.repeat(first + n, n)
        for step in range(1, COMMON):  # the rows of all small units with those so many places on
            row = row[row + step < end[row]]
            if not len(row):
                break
            own = row[_near_rows(s1, s2, size, row, row + step, percent)]
            a.append(own)
            b.append(own + step)
        for at, to in zip(first[~small].tolist(), (first + n)[~small].tolist()):
            pairs, many = [], False
            for i, j in _unit_pairs(s1[at:to], s2[at:to], size[at:to], tile[at:to], percent):
                pairs.append((i, j))
                if sum(len(x) for x, _ in pairs) > COMMON * (to - at):  # only what they connect is held
                    many = True
                    pairs = [tuple(_chunk_forest(*(pa.array(np.concatenate(x)) for x in zip(*pairs))))]
            if not pairs:
                continue
            i, j = (np.concatenate(x) for x in zip(*pairs))
            if not many:
                a.append(i + at)
                b.append(j + at)
                continue
            below, root = _chunk_forest(pa.array(i), pa.array(j))
            inside, group = np.r_[below, np.unique(root)], np.r_[root, np.unique(root)]
            members.append(node[at + inside])
            counts.append(np.bincount(group)[group])
            groups.append(signed(mix(mix(bucket[at: at + 1].view(np.uint64) ^ mix(low[at] << 32 | high[at])) ^ node[at + group].view(np.uint64))))
        a, b = (node[np.concatenate([np.zeros(0, np.int64), *x])] for x in (a, b))
        a, b = a[a != b], b[a != b]
        group, member, count = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (groups, members, counts))
        return pa.RecordBatch.from_arrays([
            pa.array(np.r_[np.minimum(a, b), member]), pa.concat_arrays([pa.array(np.maximum(a, b)), pa.nulls(len(member), pa.int64())]),
            pa.concat_arrays([pa.nulls(len(a), pa.int64()), pa.array(group)]),
            pa.concat_arrays([pa.nulls(len(a), pa.int64()), pa.array(count.astype(np.int64))])], names=["a", "b", "bucket", "n"])

    def run(batches):
        held, rows = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            rows += batch.num_rows
            if rows > _HELD_ROWS:
                table = pa.Table.from_batches(held)
                keys = np.stack([table.column(x).to_numpy() for x in _UNIT_COLUMNS[:3]])
                cut = int(np.flatnonzero((keys != keys[:, -1:]).any(axis=0))[-1]) + 1 if (keys != keys[:, -1:]).any() else 0
                if cut:
                    yield compared(table.slice(0, cut))
                    held = table.slice(cut).to_batches()
                    rows -= cut
        if rows:
            yield compared(pa.Table.from_batches(held))
    return run


def _near_in_buckets(keys: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """The near pairs (a, b) of lines that share a block, and buckets (bucket, node, n) of those that are too many to list.

    Only ids go through the shuffle by block; most blocks hold one line. What
    is left gets its bits and is compared in units: a bucket of up to
    ``TILE`` lines, or each pair of tiles of a larger one.
    """
    spark = keys.sparkSession
    members = keys.select(F.explode("blocks").alias("bucket"), F.col("h1").alias("node"))
    with settings(spark, _ROWS):
        shared = written(arrow_map(members.repartition("bucket").sortWithinPartitions("bucket"), _shared_rows,
                                   "bucket long, node long, tile int"), "buckets")
    larger = written(shared.filter("tile > 0").groupBy("bucket").agg(F.max("tile").alias("last")), "tiled_buckets")
    bits = keys.groupBy(F.col("h1").alias("node")).agg(*(F.first(x).alias(x) for x in ("s1", "s2", "size")))
    dealt = shared.join(larger, "bucket", "left").withColumn(
        "with", F.explode(F.sequence(F.lit(0), F.coalesce("last", F.lit(0))))).select(
        "bucket", F.least("tile", "with").alias("low"), F.greatest("tile", "with").alias("high"), "tile", "node")
    units = dealt.join(bits, "node").select(*_UNIT_COLUMNS).repartition(*_UNIT_COLUMNS[:3]).sortWithinPartitions(*_UNIT_COLUMNS[:3])
    with settings(spark, _ROWS):
        found = written(arrow_map(units, _near_units(percent), "a long, b long, bucket long, n long"), "near_lines")
    pairs = written(found.filter("bucket is null").select("a", "b").distinct(), "line_pairs")
    hot = found.filter("bucket is not null").select("bucket", F.col("a").alias("node"), "n").distinct()
    return pairs, written(hot, "hot_buckets")


def edit_distance(a: str, b: str, most: int) -> int:
    """The Levenshtein distance of two texts, or ``most`` + 1 if it is larger.

    Equal ends are cut off; the rest is Myers' bit-parallel algorithm: one
    column of the distance table is two integers with a bit per character.
    """
    if abs(len(a) - len(b)) > most:
        return most + 1
    first = 0
    while first < min(len(a), len(b)) and a[first: first + 64] == b[first: first + 64]:
        first += 64
    first = min(first, len(a), len(b))
    while first < min(len(a), len(b)) and a[first] == b[first]:
        first += 1
    a, b = a[first:], b[first:]
    last = 0
    while last < min(len(a), len(b)) and a[len(a) - 1 - last] == b[len(b) - 1 - last]:
        last += 1
    a, b = (a[: len(a) - last], b[: len(b) - last])
    if len(a) > len(b):
        a, b = b, a
    if not a:
        return min(len(b), most + 1)
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    full, top = (1 << len(a)) - 1, 1 << (len(a) - 1)
    up, down, distance = full, 0, len(a)
    for left, c in zip(range(len(b) - 1, -1, -1), b):
        match = where.get(c, 0)
        diagonal = (((match & up) + up) ^ up) | match | down
        more = down | ~(diagonal | up) & full
        less = up & diagonal
        if more & top:
            distance += 1
        elif less & top:
            distance -= 1
        if distance - left > most:
            return most + 1
        more = more << 1 | 1
        less <<= 1
        up = (less | ~(diagonal | more)) & full
        down = more & diagonal & full
    return distance


def words_aligned(a: str, b: str, most: int) -> bool:
    """Whether changing, dropping and adding whole words turns ``a`` into ``b`` within ``most`` characters.

    If so, the edit distance is at most ``most``; if not, it may be all the
    same. At a difference the texts are taken up again at the nearest word
    that is equal, up to three words ahead.
    """
    x, y, i, j = a.split(" "), b.split(" "), 0, 0
    while True:
        while i < len(x) and j < len(y) and x[i] == y[j]:
            i += 1
            j += 1
        if i == len(x) or j == len(y):  # the blank before each word that is left counts as well
            return sum(map(len, x[i:])) + len(x) - i + sum(map(len, y[j:])) + len(y) - j <= most
        for p, q in _AHEAD:
            if i + p < len(x) and j + q < len(y) and x[i + p] == y[j + q]:
                break
        else:
            p = q = 1
        both = min(p, q)
        most -= sum(max(len(x[i + k]), len(y[j + k])) for k in range(both))
        most -= sum(len(w) + 1 for w in x[i + both: i + p]) + sum(len(w) + 1 for w in y[j + both: j + q])
        if most < 0:
            return False
        i, j = i + p, j + q


_AHEAD = sorted(((p, q) for p in range(4) for q in range(4) if p or q), key=lambda s: (max(s), s[0] + s[1]))


def close(a: str, b: str, most: int) -> bool:
    """Whether the edit distance is at most ``most``; most near lines differ in few words, which is told sooner."""
    return words_aligned(a, b, most) or edit_distance(a, b, most) <= most


def _close_pairs(percent: int):
    def run(batches):
        for batch in batches:
            kept = []
            for a, b in zip(batch.column("line_a").to_pylist(), batch.column("line_b").to_pylist()):
                most = max(len(a), len(b)) * (100 - percent) // 100
                kept.append(close(a, b, most))
            yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))
    return run


def _close_lines(percent: int):
    """For the lines of one unit: which of some others are links of one."""
    def prepare(values):
        rows = values.to_pylist()
        own, size = [x["line"] for x in rows], np.array([len(x["line"]) for x in rows])
        bits = np.array([[x["s1"], x["s2"]] for x in rows], np.int64).view(np.uint64)

        def near(i: int, others: np.ndarray) -> np.ndarray:
            longer = np.maximum(size[i], size[others])
            out = 100 * np.minimum(size[i], size[others]) >= percent * longer
            out &= np.bitwise_count(bits[others] ^ bits[i]).sum(axis=1) <= MAX_BITS
            for k in np.flatnonzero(out).tolist():
                most = int(longer[k]) * (100 - percent) // 100
                out[k] = close(own[i], own[others[k]], most)
            return out
        return near
    return prepare


def similar_lines(near: DataFrame, lines: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of ``near`` (a < b) that are linked by their bits and their edit similarity, written."""
    def side(x: str) -> DataFrame:
        return lines.select(F.col("node").alias(x), F.struct("s1", "s2").alias(f"bits_{x}"), F.col("line").alias(f"line_{x}"))

    near = near.filter("a < b")  # all pairs; where a scan has a filter, Spark builds the Bloom filter of its ids
    both = near.join(side("a"), "a").join(side("b"), "b").filter(_near(F.col("bits_a"), F.col("bits_b")))
    longer, shorter = F.greatest(F.length("line_a"), F.length("line_b")), F.least(F.length("line_a"), F.length("line_b"))
    both = both.filter(100 * shorter >= percent * longer).select("a", "b", "line_a", "line_b")
    with settings(near.sparkSession, BLOOM):  # lines that are in no pair stay out of the shuffles
        return written(arrow_map(both, _close_pairs(percent), "a long, b long").distinct(), "links")


def _links(pairs: DataFrame, verify) -> DataFrame:
    """Edges (a, b) that connect what the links among ``pairs`` connect, with few pairs verified.

    Each line is compared with its first partner; of the other pairs only those
    whose ends are not connected by then.
    """
    first = written(pairs.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), "line_pairs")
    labels = connected_components(written(verify(first), "links"))
    rest = pairs.join(first, ["a", "b"], "left_anti")
    for x in ("a", "b"):
        of = labels.select(F.col("node").alias(f"node_{x}"), F.col("component").alias(f"label_{x}"))
        rest = rest.join(of, F.col(x) == F.col(f"node_{x}"), "left").withColumn(f"label_{x}", F.coalesce(f"label_{x}", x))
    rest = written(rest.filter("label_a <> label_b").select("a", "b"), "line_pairs")
    return written(verify(rest).union(labels.select(F.col("node").alias("a"), F.col("component").alias("b"))), "links")


def _written_lines(rows: DataFrame, kind: str) -> tuple[DataFrame, DataFrame]:
    """The lines, and the distinct lines of each slice with their blocks, from one reading of the texts."""
    spark, path = rows.sparkSession, work_dir(rows.sparkSession, "llm", "lines")
    schema = (f"doc_id {kind}, text_hash long, line_no int, h1 long, h2 long, s1 long, s2 long, size int, blocks array<long>, kind int")
    bound_batches(spark)
    empty = spark.createDataFrame([], schema)
    found = rows.mapInArrow(_lines(to_arrow_schema(empty.schema)), schema)
    with settings(spark, {"spark.sql.maxConcurrentOutputFileWriters": "4"}):  # both kinds side by side, without a sort
        found.write.partitionBy("kind").parquet(path)
    every = spark.read.schema(empty.schema).parquet(path)
    return (every.filter(F.col("kind") == _LINE).select("doc_id", "text_hash", "line_no", "h1", "h2"),
            every.filter(F.col("kind") == _CLASS).select("h1", "s1", "s2", "size", "blocks"))


def removed_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """doc_id, text_hash and line_no of every line that repeats an earlier line of its group."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_hash"),
                       F.col(text_col).alias("text"))
    kind = dict(rows.dtypes)["doc_id"]
    lines, keys = _written_lines(rows, kind)
    place = F.struct("doc_id", "text_hash", "line_no")
    classes = written(lines.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.max(place).alias("last")), "line_classes")
    pairs, hot = _near_in_buckets(keys, percent)
    nodes = pairs.select(F.col("a").alias("h1")).union(pairs.select("b")).union(hot.select("node")).distinct()
    known = join_few(classes.select("h1", "first"), nodes, "h1", name="known_lines")
    wanted = known.groupBy(F.col("first.doc_id").alias("id"), F.col("first.text_hash").alias("hash")).agg(F.collect_list(
        F.struct(F.col("first.line_no").alias("line_no"), "h1")).alias("wanted"))  # lines of one document
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_hash") == F.col("hash"))
    # the lines alone are written, not the texts that they stand in
    texts = join_few(rows, wanted, same, name="line_texts", then=lambda here: arrow_map(
        here.select("text", "wanted"), _line_texts, "node long, line string, s1 long, s2 long").distinct())
    links = _links(pairs, lambda near: similar_lines(near, texts, percent))
    labels = bucket_components(hot, lambda found: similar_lines(found, texts, percent), links,
                               texts.select("node", F.struct("line", "s1", "s2").alias("value")), _close_lines(percent))

    # groups of several classes, then classes alone that occur several times
    members = labels.select(F.col("node").alias("h1"), F.col("component").alias("group")).union(
        labels.select("component", "component").distinct())
    grouped = join_few(classes.select("h1", "h2", "first", "last"), members, "h1", name="line_groups")
    firsts = grouped.groupBy("group").agg(F.min("first").alias("group_first"))
    alone = classes.filter("not (first <=> last)").join(members, "h1", "left_anti").select(
        "h1", "h2", F.col("first").alias("group_first"))
    repeated = grouped.join(firsts, "group").select("h1", "h2", "group_first").union(alone).withColumnsRenamed(
        {"h1": "k1", "h2": "k2"})
    found = join_few(lines.select("doc_id", "text_hash", "line_no", "h1", "h2"), repeated,
                     (F.col("h1") == F.col("k1")) & (F.col("h2") == F.col("k2")), name="repeated_lines")
    return found.filter(~place.eqNullSafe(F.col("group_first"))).select("doc_id", "text_hash", "line_no").distinct()


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """``docs`` without the repeated lines, and with line_count and removed_count (longs) for each row."""
    gone = removed_lines(docs, id_col, text_col, percent).groupBy("doc_id", "text_hash").agg(
        F.collect_list("line_no").alias("lines_gone"))  # lines of one document
    gone = gone.withColumnsRenamed({"doc_id": "gone_id", "text_hash": "gone_hash"})
    joined = docs.withColumn("dedup_hash", F.xxhash64(text_col)).join(
        gone, F.col(id_col).eqNullSafe(F.col("gone_id")) & (F.col("dedup_hash") == F.col("gone_hash")), "left")
    lines = F.split(text_col, "\n", -1)
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("lines_gone"))
    text = F.when(F.col("lines_gone").isNull(), F.col(text_col)).otherwise(
        let(lines, lambda own: F.array_join(F.transform(kept, lambda i: F.element_at(own, i + 1)), "\n")))
    counts = {"line_count": F.when(F.col(text_col).isNull(), 0).otherwise(F.size(lines)).cast("long"),
              "removed_count": F.coalesce(F.size("lines_gone"), F.lit(0)).cast("long")}
    return joined.withColumns(counts).withColumn(text_col, text).select(*docs.columns, *counts)
