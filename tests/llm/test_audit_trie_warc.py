"""Filter audit, prefix trie and web archives against brute force."""

import gzip
import hashlib
import random
import zlib
from collections import Counter
from itertools import permutations

import pytest

from contactflow.llm import filter_audit, loser_tree, prefix_trie, ternary_tree, warc

LAST = 2**63 - 1


# Filter audit


def audited(rows, labels):
    """Result rows of (doc_id, text, lang) by simulating every order on every document."""
    first = {}
    for d, t, _ in rows:
        first[t or ""] = min(first.get(t or "", LAST), LAST if d is None else d)
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, x in labels if x == 1 and d is not None}
    docs = []
    for d, t, lang in rows:
        t = t or ""
        words = t.encode().split()
        fails = set()
        fails |= {"A"} if len(words) < 100 else set()
        fails |= {"B"} if 100 * len(set(words)) < 80 * len(words) else set()
        fails |= {"C"} if 100 * sum("A" <= c <= "Z" for c in t) > 10 * len(t) else set()
        fails |= {"D"} if set(t) & set("#$%&*|") else set()
        fails |= {"E"} if first[t] < (LAST if d is None else d) else set()
        docs.append((lang or "", fails, d in good, d in toxic))
    out = []
    for part in {p for p, *_ in docs}:
        mine = [x for x in docs if x[0] == part]
        steps, total = [], Counter()
        for order in map("".join, permutations("ABCDE")):
            left, gone = mine, []
            for i, f in enumerate(order, 1):
                removed = [x for x in left if f in x[1]]
                redundant = sum(f in x[1] for x in gone)
                left, gone = [x for x in left if f not in x[1]], gone + removed
                total[f] += len(removed)
                alone = sum(x[1] == {f} for x in mine)
                steps.append((f, part, order, i, len(left), len(removed), redundant, alone, sum(x[2] for x in removed), sum(x[3] for x in removed)))
        out += [(*s[1:], total[s[0]]) for s in steps]
    return out


AUDITED = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
DOCS = "doc_id long, text string, lang string, part string, mask int, digest binary, packed binary"


def audit_rows():
    rng = random.Random(11)

    def text():
        vocabulary = [f"w{i}" for i in range(rng.choice([20, 400]))] + rng.choice([[], ["LOUD"] * 60, ["a#b"], ["Été", "ß"]])
        return " ".join(rng.choice(vocabulary) for _ in range(rng.choice([5, 99, 100, 150])))

    rows = [(i, text(), rng.choice(["en", "de", None, ""])) for i in range(60)]
    rows += [(100 + i, rows[i][1], "en") for i in range(0, 20, 2)] + [rows[3], rows[5]]
    rows += [(None, None, None), (None, rows[7][1], "de"), (None, "no id", "de"), (None, "no id", "de"), (200, "", "en"), (201, None, "en")]
    rows += [(202, " \t\n", "fr"), (203, "word " * 200_000, "fr"), (-5, rows[9][1], "en")]
    labels = [(d, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for d, _, _ in rows] + [(3, 1, 0), (3, 0, 1), (999, 1, 1)]
    return rows, labels


def test_filter_audit(spark):
    rows, labels = audit_rows()
    docs = spark.createDataFrame([(d, t, lang, "x", 1, b"y", b"z") for d, t, lang in rows], DOCS).repartition(7)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = filter_audit.audit(spark, docs, marks)
    assert got.columns == AUDITED
    assert sorted(map(tuple, got.collect())) == sorted(audited(rows, labels))
    assert filter_audit.audit(spark, docs.limit(0), marks).count() == 0
    assert filter_audit.audit(spark, docs, marks.limit(0)).agg({"good_lost": "sum"}).first()[0] == 0


def test_filter_audit_hands_on_sums_of_many_parts(spark, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(filter_audit, "PARTS_AT_A_TIME", 3)
    parts = [f"p{i % 10}" for i in range(200)]
    batch = pa.RecordBatch.from_pydict({"part": parts, "mask": pa.array([i % 32 for i in range(200)], pa.int32()), "good": [i % 3 == 0 for i in range(200)], "toxic": [False] * 200})
    partial = [row for b in filter_audit._add_outcomes([batch]) for row in b.to_pylist()]
    assert len(partial) > 10
    partial.sort(key=lambda r: r["part"])
    sums = [row for b in filter_audit._add_sums(pa.Table.from_pylist(partial).to_batches(max_chunksize=4)) for row in b.to_pylist()]
    assert [r["part"] for r in sums] == sorted(set(parts))
    table = filter_audit.packed_outcomes()
    for r in sums:
        i = int(r["part"][1:])
        want = sum(table[j % 32, j % 3 == 0, False] for j in range(i, 200, 10))
        assert int.from_bytes(r["packed"], "little") == want


def test_packed_fields_do_not_overflow():
    big = filter_audit.packed_outcomes()[0, True, True] * (2**63 - 1)
    columns = filter_audit.unpack("", big.to_bytes(filter_audit.WIDTH, "little"))
    assert set(columns["kept"]) == {2**63 - 1} and set(columns["removed"]) == {0}


# Prefix trie


def trie_by_hand(rows):
    """Result rows of (conv_id, turn, role, text) from every prefix of every rebuilt conversation."""
    convs = {}
    for c, n, r, t in rows:
        digest = hashlib.sha256(f"{len(r or '')}:{r or ''}{t or ''}".encode()).digest()
        convs.setdefault(c, []).append((n is not None, n or 0, digest, (r or "", t or "")))
    own = {c: [x[-1] for x in sorted(turns)] for c, turns in convs.items()}
    built = {}
    for c, turns in own.items():
        h = 0 if c is None else zlib.crc32(str(c).encode()) % 6
        base = [] if c is None else own.get(c - (abs(c) % 100) * (1 if c >= 0 else -1), [])
        built[c] = tuple(base[:h] + turns[h:])
    members = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(LAST if c is None else c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1]) if p else 0
    shown = lambda c: None if c == LAST else c
    out = []
    for p, m in members.items():
        ended = sorted(LAST if c is None else c for c, turns in built.items() if turns == p)
        text = ",".join("" if c == LAST else str(c) for c in ended)
        parent = shown(min(members[p[:-1]])) if p else None
        out.append((shown(min(m)), len(p), parent, len(m), children[p], leaves[p], saved[p], hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


TURNS = "conv_id long, turn long, role string, text string, seq string, conv string, shard int, key string"


@pytest.fixture(scope="module")
def talks():
    rng = random.Random(13)
    rows = []
    for c in [*range(0, 160), *range(300, 320), 1000, 1001, -3, -100, None]:
        copy = rng.random() < 0.3
        for n in range(rng.randint(1, 9)):
            rows.append((c, n, rng.choice(["user", "bot"]) if not copy else "user", f"{'é' * n} {rng.randint(0, 2) if not copy else 0}"))
    rows += [(500, None, None, None), (500, 3, "user", ""), (500, 3, "bot", "x"), (500, None, "user", "late null"), (501, 0, "user", "a"), (501, 0, "user", "a")]
    rows += [(600, n, "user", str(n % 7)) for n in range(400)] + [(601, n, "user", str(n % 7)) for n in range(700)] + [(602, 0, "user", "long " * 200_000)]
    return rows


@pytest.mark.parametrize(("shard_turns", "block_turns"), [(prefix_trie.SHARD_TURNS, prefix_trie.BLOCK_TURNS), (300, 40), (60, 1)])
def test_prefix_trie(spark, talks, monkeypatch, shard_turns, block_turns):
    monkeypatch.setattr(prefix_trie, "PIECE_IDS", 3)
    frame = spark.createDataFrame([(*r, "x", "y", 0, "z") for r in talks], TURNS)
    got = prefix_trie.prefix_trie(spark, frame, shard_turns, block_turns)
    assert sorted(map(tuple, got.collect()), key=str) == trie_by_hand(talks)


def test_prefix_trie_of_few_rows(spark):
    for rows in ([], [(7, 0, "user", "hi")], [(c, 0, "u", "same") for c in range(300, 400, 3)], [(5, 0, None, None)] * 4):
        frame = spark.createDataFrame([(*r, "x", "y", 0, "z") for r in rows], TURNS)
        assert sorted(map(tuple, prefix_trie.prefix_trie(spark, frame, 5, 5).collect()), key=str) == trie_by_hand(rows)


def test_turns_are_dealt_by_conversation_only(spark, talks, monkeypatch):
    written, write = [], prefix_trie.materialize

    def record(session, df, name):
        written.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return write(session, df, name)

    monkeypatch.setattr(prefix_trie, "materialize", record)
    rebuilt = prefix_trie.rebuild(spark, spark.createDataFrame([(*r, "x", "y", 0, "z") for r in talks], TURNS))
    assert rebuilt.count() == len({r[0] for r in talks})
    assert [name for name, _ in written] == ["rebuilt"]
    assert "hashpartitioning(conv" in written[0][1] and "hashpartitioning(digest" not in written[0][1]


def test_ternary_tree_is_balanced():
    n = 4096
    tree = ternary_tree.TernaryTree()
    assert sorted(ternary_tree.median_order(100)) == list(range(100))
    for i in ternary_tree.median_order(n):
        tree.insert([i], [1], i)
    deepest, stack = 0, [(tree.inner[0], 1)]
    while stack:
        node, depth = stack.pop()
        if node >= 0:
            deepest = max(deepest, depth)
            stack += [(tree.below[node], depth + 1), (tree.above[node], depth + 1)]
    assert deepest <= 13
    assert ternary_tree.common_prefix([1, 2, 3], [1, 2]) == 2 and ternary_tree.common_prefix([], [1]) == 0


# Web archives


def test_loser_tree():
    rng = random.Random(17)
    for k in (0, 1, 2, 3, 7, 16, 33):
        keys = [x for _ in range(k) for x in sorted(rng.choices(range(50), k=rng.randint(0, 20)))]
        order = list(loser_tree.merge(keys, loser_tree.sorted_runs(keys)))
        assert order == sorted(range(len(keys)), key=keys.__getitem__)
    falling = list(range(20, 0, -1))
    assert len(loser_tree.sorted_runs(falling)) == 20
    assert [falling[i] for i in loser_tree.merge(falling, loser_tree.sorted_runs(falling))] == sorted(falling)


PAGES = "page_id long, url string, html string, payload string, digest string, block string, shard int, page long"


def page_rows():
    body = "é" * 50
    rows = [(5, "http://B.example.org/x?q=1#top", body), (3, "https://www.a.example.org/", body), (9, None, body), (None, "", body), (3, "x", body)]
    rows += [(10, "http://c/", "s" * 99), (11, "http://c/", "s" * 99), (12, "http://c/\r\nEvil: 1", None), (13, "http://c/%41 b\t", "")]
    rows += [(14, "http://c/", "WARC/1.1\r\n\r\n\r\n\r\nWARC/1.1\r\n" * 30), (15, "http://c/", "x\r\n\r\n" * 200_000), (None, None, None)]
    rows += [(20, "http://c/p", f"{i % 3}" * 100 + "z") for i in range(3)] + [(-1, "http://host", "1" * 100 + "z"), (20, "http://c/p", "0" * 100 + "z")]
    return rows + [(100 + i, f"http://{'hot' if i % 3 else i}.org/", f"page {i // 2} " * 20) for i in range(60)]


def archived(rows):
    first = {}
    for p, _, h in rows:
        first[h or ""] = min(first.get(h or "", LAST), LAST if p is None else p)
    for p, u, h in rows:
        raw = (h or "").encode()
        to = first[h or ""] if len(raw) >= 100 and first[h or ""] < (LAST if p is None else p) else None
        yield p, u, len(raw), hashlib.sha256(raw).hexdigest(), "response" if to is None else "revisit", to


@pytest.mark.parametrize("captures", [100_000, 7])
def test_archives_round_trip(spark, monkeypatch, captures):
    monkeypatch.setattr(warc, "SHARD_CAPTURES", captures)
    rows = page_rows()
    frame = spark.createDataFrame([(*r, "a", "b", "c", 0, 1) for r in rows], PAGES).repartition(5)
    got = warc.archive_pages(spark, frame).collect()
    found = Counter((r.page_id, r.url, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got)
    assert found == Counter(archived(rows))
    history = sorted(got, key=lambda r: (r.shard, r.place))
    keys = [(r.url_key, r.captured, r.file, r.offset) for r in history]
    assert keys == sorted(keys) and len(set(keys)) == len(rows)
    if captures == 7:
        assert len({r.shard for r in got}) > 5
    assert warc.archive_pages(spark, frame.limit(0)).count() == 0


def test_archive_files_are_warc(spark):
    rows = page_rows()
    frame = spark.createDataFrame([(*r, "a", "b", "c", 0, 1) for r in rows], PAGES)
    path = warc.write_archive(spark, frame).removeprefix("file:")
    from pathlib import Path

    texts = [gzip.decompress(p.read_bytes()) for p in sorted(Path(path).glob("*.gz"))]
    seen = 0
    for text in texts:
        at = 0
        while at < len(text):
            head, _, rest = text[at:].partition(b"\r\n\r\n")
            lines = head.decode().split("\r\n")
            assert lines[0] == "WARC/1.1" and not any(line.startswith("Evil") for line in lines)
            length = next(int(line.split(": ")[1]) for line in lines if line.startswith("Content-Length"))
            assert rest[length : length + 4] == b"\r\n\r\n"
            at += len(head) + 4 + length + 4
            seen += 1
        assert [offset for offset, _, _ in warc.read_records(gzip.compress(text))][0] == 0
    assert seen == len(rows)


def test_damaged_archives_are_refused():
    head = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 4\r\n\r\n"
    good = gzip.compress(f"{head}abcd\r\n\r\n".encode())
    assert [b for _, _, b in warc.read_records(good + good)] == [b"abcd", b"abcd"]
    for text in (f"{head}abc", f"{head}abcdef\r\n\r\n", "HTTP/1.1 200\r\n\r\n", head[:20]):
        with pytest.raises(ValueError):
            list(warc.read_records(gzip.compress(text.encode())))
    assert warc.url_key("http://WWW.B.org/a?b#c") == "org,b)/a?b" and warc.url_key("") == ")"
