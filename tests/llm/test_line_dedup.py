import math
import random
import re

import numpy as np

from martforge.llm import line_dedup as D
from martforge.llm.text import Texts, span_hashes

from .conftest import letters, rows_of, sample_rows, words


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_edit_distance():
    rng = random.Random(3)
    for _ in range(800):
        a = "".join(rng.choice("abcé") for _ in range(rng.randrange(0, 70)))
        b = list(a if rng.random() < 0.8 else "")
        for _ in range(rng.randrange(0, 9)):
            b.insert(rng.randrange(len(b) + 1), rng.choice("abcé"))
        b, most = "".join(b), rng.randrange(0, 40)
        assert D.edit_distance(a, b, most) == min(plain_distance(a, b), most + 1)


def test_near_lines_are_told_by_their_words(monkeypatch):
    """Without the table of distances where few words differ; never beyond the distance."""
    rng, pool = random.Random(8), ["a", "bb", "ccc", "d\u00e9", "fgh", "zzzzzz"]
    for _ in range(4000):
        a = [rng.choice(pool) for _ in range(rng.randrange(0, 9))]
        b = list(a)
        for _ in range(rng.randrange(0, 4)):
            at = rng.randrange(len(b) + 1)
            b[at: at + rng.randrange(2)] = rng.sample(pool, rng.randrange(2))
        a, b, most = " ".join(a), " ".join(b), rng.randrange(0, 12)
        near = plain_distance(a, b) <= most
        assert D.close(a, b, most) == near and D.words_aligned(a, b, most) <= near
    line = words(rng, 60, 5000)
    other = line[:20] + ["new"] + line[22:40] + ["some", "more"] + line[40:]
    monkeypatch.setattr(D, "edit_distance", None)
    assert D.close(" ".join(line), " ".join(other), 60)


def test_only_wanted_lines_are_read_into_words(monkeypatch):
    """Line text and bits as from the whole text, and no word of another line is hashed."""
    import pyarrow as pa

    text = "One, two-three\tFOUR 55 \u00c9t\u00e9\nnot wanted at all\n  six seven  eight nine ten eleven\n"
    batch = pa.RecordBatch.from_pydict({"text": [text, None, "x"], "wanted": pa.array(
        [[{"line_no": 2, "h1": 7}, {"line_no": 0, "h1": 5}], [], []], pa.list_(pa.struct([("line_no", pa.int32()), ("h1", pa.int64())])))})
    hashed, real = [], D.span_hashes
    monkeypatch.setattr(D, "span_hashes", lambda data, starts, ends: hashed.append(len(starts)) or real(data, starts, ends))
    got = [r for b in D._line_texts([batch]) for r in b.to_pylist()]
    lines = ["six seven eight nine ten eleven", "one two three four 00 \u00c9t\u00e9"]
    assert [(r["node"], r["line"]) for r in got] == [(7, lines[0]), (5, lines[1])] and sum(hashed) == 12
    bits = [(r["s1"] % 2 ** 64) << 64 | r["s2"] % 2 ** 64 for r in got]
    assert bits == [bits_of(x) for x in lines]


def normal(line):
    plain = "".join(("0" if c.isdigit() else c.lower() if c.isalnum() else " ") if c < "\x80" else c for c in line)
    return [w for w in re.split(r"[\x20\x09-\x0D]+", plain) if w]


def hashes_of(line):
    raw = line.encode()
    texts = Texts(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
    return np.unique(span_hashes(texts.data, *texts.word_spans()))


def vote(hashes, salt=0):
    """The bits that more than half of the hashes have."""
    mixed = [int(x) for x in D.mix(np.array(hashes, np.uint64) ^ np.uint64(salt))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in mixed) > len(mixed))


def bits_of(line):
    return vote(hashes_of(line)) << 64 | vote(hashes_of(line), 0xA5A5A5A5DEADBEEF)


def blocks_of(line):
    """(groups, group, bits) of every block of a line."""
    hashes = hashes_of(line)
    mixed, out = [int(x) for x in D.mix(hashes)], set()
    for edge in (-D.EDGE, D.EDGE):
        groups = 2 ** max(1 if len(hashes) < D.FEW_WORDS else 2, round(math.log2(len(hashes) / D.GROUP_WORDS) + edge))
        for g in range(groups):
            own = [h for h, m in zip(hashes, mixed) if (m >> 24) % groups == g]
            if own:
                out.add((groups, g, vote(own)))
    return out


def test_simhash_is_a_majority_of_bits():
    rng = np.random.default_rng(2)
    count = np.array([1, 700, 3, 255, 256, 40])
    hashes = rng.integers(0, 2 ** 63, count.sum()).astype(np.uint64)
    high, low = D.simhash(hashes, count)
    for i, own in enumerate(np.split(hashes, np.cumsum(count)[:-1])):
        for half, salt in ((high, 0), (low, 0xA5A5A5A5DEADBEEF)):
            assert int(half[i]) == vote(own, salt)


def plain_result(rows):
    """Every document's text after the later lines of each group are cut, all pairs compared."""
    where = {}
    for doc_id, text in sorted(((r[0], r[1]) for r in rows if r[1] is not None), key=lambda r: (r[0] is not None, r)):
        for number, line in enumerate(text.split("\n")):
            w = normal(line)
            if len(w) >= D.MIN_WORDS or len(" ".join(w)) >= D.MIN_CHARS:
                where.setdefault(" ".join(w), []).append((doc_id is not None, doc_id, number))
    lines = list(where)
    bits, blocks = [bits_of(x) for x in lines], [blocks_of(x) for x in lines]
    parent = list(range(len(lines)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = 0
    long = [i for i, x in enumerate(lines) if len(x.split(" ")) >= D.MIN_WORDS]
    for i in long:
        for j in (j for j in long if j < i):
            if blocks[i] & blocks[j] and (bits[i] ^ bits[j]).bit_count() <= D.MAX_BITS:
                longer = max(len(lines[i]), len(lines[j]))
                if plain_distance(lines[i], lines[j]) <= longer * (100 - D.PERCENT) // 100:
                    links += 1
                    parent[find(i)] = find(j)
    first = {}
    for i, line in enumerate(lines):
        first[find(i)] = min(first.get(find(i), min(where[line])), min(where[line]))
    gone = {place[1:] for i, line in enumerate(lines) for place in where[line] if place != first[find(i)]}
    kept = [(d, None if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if (d, n) not in gone))
            for d, t in ((r[0], r[1]) for r in rows)]
    return sorted(kept, key=repr), links


def test_lines_are_cut_as_by_comparing_all(docs, clashing):
    expect, _ = plain_result(sample_rows())
    got = D.dedup_lines(docs)
    assert rows_of(got, "doc_id", "text") == expect
    assert got.columns == [*docs.columns, "line_count", "removed_count"]
    counts = {r["doc_id"]: (r["line_count"], r["removed_count"]) for r in got.collect()}
    assert counts[49] == (3, 1) and counts[48] == (2, 0) and counts[42] == (0, 0) and counts[43] == (1, 0)
    assert rows_of(D.dedup_lines(clashing), "doc_id", "text") == expect


def near_lines(n):
    rng = random.Random(6)
    bases = [words(rng, 60, 5000) for _ in range(6)]
    rows = []
    for i in range(n):
        line = list(rng.choice(bases))
        for _ in range(rng.randrange(0, 3)):
            line[rng.randrange(len(line))] = letters(rng.randrange(5000))
        rows.append((i, "Title\n" + " ".join(line), "en", "a", 1))
    return rows


def test_fuzzy_lines(spark, monkeypatch):
    rows = near_lines(90)
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int")
    expect, links = plain_result(rows)
    assert links > 50
    assert rows_of(D.dedup_lines(table), "doc_id", "text") == expect


def test_buckets_of_every_size_give_the_same_lines(spark, monkeypatch):
    """With nearly every bucket above the bound: stars and tiles link what comparing inside the bucket does."""
    monkeypatch.setattr(D, "COMMON", 2)
    rows = near_lines(90)
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int")
    assert rows_of(D.dedup_lines(table), "doc_id", "text") == plain_result(rows)[0]


def all_pairs_result(rows):
    """As plain_result, linked by edit similarity alone; and the number of links."""
    where = {}
    for doc_id, text in rows:
        for number, line in enumerate(text.split("\n")):
            where.setdefault(" ".join(normal(line)), []).append((doc_id, number))
    lines, links = sorted(where, key=len), 0
    parent = {x: x for x in lines}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, b in enumerate(lines):
        most = len(b) * (100 - D.PERCENT) // 100
        for a in lines[:i]:
            if D.edit_distance(a, b, most) <= most:
                links += 1
                parent[find(a)] = find(b)
    first = {}
    for x in lines:
        first[find(x)] = min(first.get(find(x), min(where[x])), min(where[x]))
    gone = {place for x in lines for place in where[x] if place != first[find(x)]}
    return sorted(((d, "\n".join(x for n, x in enumerate(t.split("\n")) if (d, n) not in gone)) for d, t in rows), key=repr), links


def test_most_near_lines_of_all_pairs_are_found(spark):
    """Lines with up to a twelfth of their words replaced, against all pairs by edit similarity alone: 0.9 of the links at least."""
    rng, rows = random.Random(21), []
    for i in range(120):
        base = [letters(rng.randrange(10 ** 6)) for _ in range(rng.choice((12, 20, 40, 80)))]
        for copy in range(2):
            line = list(base)
            if copy:
                for place in rng.sample(range(len(base)), max(1, len(base) // 12)):
                    line[place] = letters(rng.randrange(10 ** 6))
            rows.append((2 * i + copy, " ".join(line)))
    expect, links = all_pairs_result(rows)
    assert links >= 115
    got = rows_of(D.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")), "doc_id", "text")
    cut, wanted = ({d for d, t in x if not t} for x in (got, expect))
    assert cut <= wanted and len(cut) >= 0.9 * len(wanted)


def test_lines_that_differ_in_fewer_words_than_blocks_share_one():
    rng = random.Random(4)
    for _ in range(200):
        base = [letters(rng.randrange(10 ** 6)) for _ in range(rng.choice((12, 24, 48, 96)))]
        groups = min(g for g, _, _ in blocks_of(" ".join(base)))
        line = list(base)
        for place in rng.sample(range(len(base)), (groups - 1) // 2):  # each touches two blocks at most
            line[place] = letters(rng.randrange(10 ** 6))
        assert blocks_of(" ".join(base)) & blocks_of(" ".join(line))


def test_short_lines_that_repeat_exactly_are_cut(spark):
    """Of few words, or in a script without blanks; nearly equal ones and the shortest stay."""
    chinese = "\u6211\u4eec\u7684\u7f51\u7ad9\u4f7f\u7528\u5c0f\u578b\u6587\u4ef6"
    rows = [(1, f"All rights reserved\n{chinese}\nTitle\nsubscribed"),
            (2, f"ALL RIGHTS RESERVED.\n{chinese}\nTitle\nsubscribes"), (3, f"a\n{chinese}")]
    got = D.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    assert rows_of(got, "doc_id", "text") == [rows[0], (2, "Title\nsubscribes"), (3, "a")]


def test_near_lines_of_few_words_are_cut(spark):
    """One word changed, added or dropped in two to four: linked where bits and edit similarity allow it, as longer lines are."""
    rng, rows, wanted = random.Random(17), [], set()
    for i in range(150):
        base = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(10)) for _ in range(rng.choice((2, 3, 4)))]
        other, at = list(base), rng.randrange(len(base))
        if i % 3 == 0 and len(base) < 4:
            other.insert(at, "xy")
        else:
            other[at] = other[at][:-2] + "ZZ"
        a, b = " ".join(base), " ".join(other)
        rows += [(2 * i, a), (2 * i + 1, b)]
        near = [" ".join(normal(x)) for x in (a, b)]
        most = max(map(len, near)) * (100 - D.PERCENT) // 100
        if (bits_of(near[0]) ^ bits_of(near[1])).bit_count() <= D.MAX_BITS and plain_distance(*near) <= most:
            wanted.add(2 * i + 1)
    assert 60 < len(wanted) < 150 and {len(t.split()) for d, t in rows if d in wanted} == {2, 3, 4}
    got = rows_of(D.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")), "doc_id", "text")
    assert {d for d, t in got if not t} == wanted


def test_blocks_of_few_words_leave_each_word_out():
    count = np.array([1, 7, 3, 2])
    hashes = np.random.default_rng(3).integers(0, 2 ** 63, count.sum()).astype(np.uint64)
    keys, of = D.few_word_keys(hashes, count, np.array([True, False, True, True]))
    found = [{int(k) for k, o in zip(keys, of) if o == line} for line in range(4)]
    assert [len(x) for x in found] == [1, 0, 4, 3]
    two = hashes[[9, 8]]  # the second line of three without its last word, in another order
    keys, _ = D.few_word_keys(two, np.array([2]), np.array([True]))
    assert len({int(k) for k in keys} & found[2]) == 1


def test_empty_table(empty):
    assert D.dedup_lines(empty).collect() == []


def test_texts_are_not_stored_beside_their_lines(spark):
    import glob
    import os

    from martforge.llm.line_dedup import removed_lines
    from martforge.session import shared_dir

    line = "the quick brown fox jumps over the lazy dog near the river bank today"
    docs = spark.createDataFrame([(1, f"{line}\nsome other words that stand alone here"), (2, line.replace("today", "now"))],
                                 "doc_id long, text string")
    store = f"{shared_dir(spark).removeprefix('file:')}/martforge/llm"
    before = set(glob.glob(f"{store}/*/*"))
    assert [tuple(r)[::2] for r in removed_lines(docs).collect()] == [(2, 0)]
    kinds = {os.path.basename(os.path.dirname(p)) for p in set(glob.glob(f"{store}/*/*")) - before}
    assert "line_texts" in kinds and "line_sources" not in kinds


def test_rows_of_shared_buckets_come_with_their_tiles(monkeypatch):
    """Buckets that span batches, hold one node only, or name it twice."""
    import pyarrow as pa

    monkeypatch.setattr(D, "TILE", 4)
    rng = random.Random(5)
    rows = sorted((b, rng.randrange(30)) for b, n in enumerate([1, 2, 1, 23, 1, 1, 9, 2]) for _ in range(n))
    rows += [(50, 7), (50, 7)]
    for size in (1, 3, 100):
        batches = [pa.RecordBatch.from_pydict({"bucket": [b for b, _ in rows[k: k + size]], "node": [v for _, v in rows[k: k + size]]})
                   for k in range(0, len(rows), size)]
        got = [tuple(r.values()) for x in D._shared_rows(batches) for r in x.to_pylist()]
        several = {b for b, _ in rows if len({v for c, v in rows if c == b}) > 1}
        assert {(b, v) for b, v, _ in got if b in several} == {r for r in rows if r[0] in several}
        assert {b for b, _, _ in got} <= several | {50} and [b for b, _, _ in got] == sorted(b for b, _, _ in got)
        for b in several:
            assert [t for c, _, t in got if c == b] == [k // 4 for k in range(sum(c == b for c, _, _ in got))]


def unit_rows(n, seed):
    """Rows of one unit of ``n`` lines: families of bits that differ in few places."""
    rng = random.Random(seed)
    bases = [rng.getrandbits(128) for _ in range(n // 9)]
    rows = []
    for node in range(n):
        bits = rng.choice(bases)
        for _ in range(rng.randrange(0, 20)):
            bits ^= 1 << rng.randrange(128)
        rows.append((node, bits, rng.randrange(80, 130)))
    return rows


def near_nodes(rows, apart=lambda a, b: True):
    return {(a, b) for a, x, m in rows for b, y, n in rows
            if a < b and apart(a, b) and (x ^ y).bit_count() <= D.MAX_BITS and 100 * min(m, n) >= D.PERCENT * max(m, n)}


def units_found(rows, tiles):
    import pyarrow as pa

    sign = lambda x: x - 2 ** 64 if x >= 2 ** 63 else x
    columns = {"bucket": [3] * len(rows), "low": [0] * len(rows), "high": [max(tiles)] * len(rows), "tile": tiles,
               "node": [r[0] for r in rows], "s1": [sign(r[1] >> 64) for r in rows], "s2": [sign(r[1] % 2 ** 64) for r in rows],
               "size": [r[2] for r in rows]}
    batch = pa.RecordBatch.from_pydict(columns)
    batch = batch.cast(pa.schema([(f.name, pa.int32() if f.name in ("low", "high", "tile", "size") else pa.int64()) for f in batch.schema]))
    return [r for x in D._near_units(D.PERCENT)([batch.slice(k, 50) for k in range(0, len(rows), 50)]) for r in x.to_pylist()]


def test_units_list_the_near_pairs_of_all_pairs():
    """In small and large units, within a tile and between two."""
    for n in (D.COMMON - 4, D.COMMON * 5):
        rows = unit_rows(n, n)
        for tiles, apart in (([0] * n, lambda a, b: True), ([k % 2 for k in range(n)], lambda a, b: a % 2 != b % 2)):
            expect = near_nodes(rows, apart)
            got = units_found(rows, tiles)
            assert expect and len(got) == len(expect) and {(r["a"], r["b"]) for r in got} == expect
            assert all(r["bucket"] is None for r in got)


def test_units_of_very_many_near_pairs_give_their_groups(monkeypatch):
    monkeypatch.setattr(D, "COMMON", 1)
    rows = unit_rows(300, 4)
    pairs, group = near_nodes(rows), {}
    for a, b in pairs:
        own = group.get(a, {a}) | group.get(b, {b})
        group.update((x, own) for x in own)
    assert len(pairs) > len(rows)
    found = {}
    for r in units_found(rows, [0] * 300):
        assert r["b"] is None
        found.setdefault((r["bucket"], r["n"]), set()).add(r["a"])
    assert sorted(map(sorted, found.values())) == sorted(map(list, {tuple(sorted(x)) for x in group.values()}))
    assert all(n == len(x) for (_, n), x in found.items())
