"""Each operator against brute force on small inputs: nulls, empty and long texts, ties, repeated rows, empty tables."""

import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

from contactflow.llm import (
    decontamination,
    exact_dedup,
    fuse_filter,
    language_id,
    quality,
    segmentation,
    shared_windows,
    simhash,
    substring_dedup,
    suffix_dedup,
    suffix_groups,
    token_counts,
    url_filter,
)
from contactflow.llm.components import connected_components
from contactflow.llm.queries import PIECES, TOKENIZER

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
rng = random.Random(7)
VOCAB = [f"w{i}" for i in range(400)]


def prose(n):
    return " ".join(rng.choice(VOCAB) for _ in range(n))


def shared_passages():
    """Documents with passages of other documents at odd places, copies, repeats, nulls and a long text."""
    passages = [prose(60), prose(50), prose(49), "é " + prose(70)]
    rows = [(i, " ".join([prose(rng.randint(0, 40)), rng.choice(passages), prose(rng.randint(0, 40)), rng.choice(passages)])) for i in range(25)]
    rows += [(30, rows[3][1]), (31, rows[3][1] + " end"), (32, None), (33, ""), (34, " \t\n"), (35, "short")]
    rows += [(36, "a " * 300), (37, "a " * 120), (38, prose(30) + passages[0][5:-5]), (None, passages[0])]
    rows += [rows[4], (39, prose(3000) + " " + passages[3])]
    return rows


def expected_removal(rows, split, join, window=50):
    units = [(d, split((t or "").encode())) for d, t in rows]
    first = {}
    for d, u in units:
        for i in range(len(u) - window + 1):
            key = join(u[i : i + window])
            first[key] = min(first.get(key, 2**63), 2**63 - 1 if d is None else d)
    out = []
    for d, u in units:
        gone = np.zeros(len(u), bool)
        for i in range(len(u) - window + 1):
            if first[join(u[i : i + window])] < (2**63 - 1 if d is None else d):
                gone[i : i + window] = True
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((d, len(u), int(gone.sum()), spans, join([x for x, g in zip(u, gone, strict=True) if not g])))
    return out


def in_batches(spans, rows):
    """_spans whose tasks get batches of so many rows, so that equal windows lie in several."""

    def build(units, engine):
        run = spans(units, engine)
        return lambda batches: run(b.slice(a, rows) for b in batches for a in range(0, len(b), rows))

    return build


@pytest.mark.parametrize("crowd", [128, 1])
def test_substring_dedup(spark, make, sha, monkeypatch, crowd):
    monkeypatch.setattr(shared_windows, "CROWD", crowd)
    rows = shared_passages()
    got = substring_dedup.deduplicate(spark, make(rows)).collect()
    want = expected_removal(rows, lambda raw: raw.split(), lambda u: b" ".join(u))
    assert Counter((r.doc_id, r.total, r.removed, r.n_spans, r.kept_sha256) for r in got) == Counter((d, n, g, s, sha(k)) for d, n, g, s, k in want)
    assert substring_dedup.deduplicate(spark, make([])).count() == 0


@pytest.mark.parametrize(("crowd", "batch"), [(128, 10_000), (1, 10_000), (1, 3)])
def test_suffix_dedup(spark, make, sha, monkeypatch, crowd, batch):
    monkeypatch.setattr(shared_windows, "CROWD", crowd)
    monkeypatch.setattr(shared_windows, "_spans", in_batches(shared_windows._spans, batch))
    rows = shared_passages()
    got = suffix_dedup.deduplicate(spark, make(rows)).collect()
    want = expected_removal(rows, list, bytes)
    assert Counter((r.doc_id, r.total, r.removed, r.n_spans, r.kept_sha256) for r in got) == Counter((d, n, g, s, sha(k)) for d, n, g, s, k in want)
    assert suffix_dedup.deduplicate(spark, make([])).count() == 0


def test_rows_without_id_are_not_one_document(spark, make, sha):
    own = random.Random(23)
    passages = [" ".join(own.choice(VOCAB) for _ in range(55)) for _ in range(6)]
    rows = [(None if i % 3 == 0 else i, f"{own.choice(VOCAB)} {i} {own.choice(passages)} {own.choice(passages)}") for i in range(90)]
    rows += [(None, rows[0][1]), (None, rows[1][1])]
    for operator, split, join in ((substring_dedup, lambda raw: raw.split(), lambda u: b" ".join(u)), (suffix_dedup, list, bytes)):
        got = operator.deduplicate(spark, make(rows)).collect()
        want = expected_removal(rows, split, join)
        assert Counter((r.doc_id, r.total, r.removed, r.kept_sha256) for r in got) == Counter((d, n, g, sha(k)) for d, n, g, _, k in want)


def test_suffix_groups_sort():
    strings = [[rng.randint(1, k) for _ in range(rng.randint(0, 30))] for k in (1, 2, 3, 9) for _ in range(60)]
    width = max(map(len, strings)) + 1
    codes = np.zeros((len(strings), width), np.int16)
    for i, s in enumerate(strings):
        codes[i, : len(s)] = s
    arrays = suffix_groups.suffix_arrays(codes, np.array([len(s) + 1 for s in strings]))
    for s, array in zip(strings, arrays, strict=True):
        closed = [*s, 0]
        assert array[: len(closed)].tolist() == sorted(range(len(closed)), key=lambda i: closed[i:])


def test_suffix_automaton():
    strings = [("abcabcd", 5), ("xabca", 3), ("bcd", 9)]
    automaton = substring_dedup.SuffixAutomaton()
    for s, n in strings:
        automaton.add(list(s), n)
    automaton.close()
    for s, _ in strings:
        want = [min(n for t, n in strings if s[i : i + 3] in t) for i in range(len(s) - 2)]
        assert automaton.holders(list(s), 3).tolist() == want


def test_exact_dedup(spark, make):
    rows = [(5, "a  b"), (2, "a b"), (9, "a\n\tb"), (1, None), (3, ""), (4, "c"), (4, "c"), (None, "c"), (7, "x" * 50_000), (8, " ")]
    def brute(keyed):
        groups = {}
        for d, t in keyed:
            groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), []).append(2**63 - 1 if d is None else d)
        return Counter((d, min(groups[k]), len(groups[k])) for d, t in keyed for k in [re.sub(r"[\x20\x09-\x0D]+", " ", t or "")])
    # A digest that collides: the byte check must tell the texts apart.
    weak_hex = lambda norm: exact_dedup.F.lpad(exact_dedup.F.hex(exact_dedup.F.length(norm) % 3), 64, "0")
    for digest in (exact_dedup.sha256, weak_hex):
        for batches in (1, 2, 3):
            got = exact_dedup.deduplicate(spark, make(rows), batches, digest).collect()
            assert Counter((r.doc_id, r.keep_id, r.group_size) for r in got) == brute(rows)
            assert all(r.kept == (r.doc_id == r.keep_id) for r in got)
    assert exact_dedup.deduplicate(spark, make([])).count() == 0


def test_fuse_filter():
    keys = np.random.default_rng(3).integers(0, 2**64, 5000, dtype=np.uint64)
    for n in (1, 2, 10, 1000, 4000):
        seed, blob = fuse_filter.build(keys[:n])
        assert fuse_filter.contains(seed, blob, keys[:n]).all()
        assert fuse_filter.contains(seed, blob, keys[4000:]).mean() < 0.05
        assert len(blob) < 1.5 * n + 700


def slow_fingerprint(text):
    words = WORD.findall((text or "").encode().lower())
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 3]), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("posting", [64, 1])
def test_simhash(spark, make, monkeypatch, posting):
    monkeypatch.setattr(simhash, "POSTING", posting)
    base = prose(400)
    rows = [(i, base.replace(f" {VOCAB[i]} ", " zz ", 1)) for i in range(30)] + [(40 + i, prose(20)) for i in range(10)]
    rows += [(60, None), (61, ""), (62, "one two"), (63, "ONE two"), (64, "one two three"), (61, ""), (None, base)]
    got = simhash.near_duplicates(spark, make(rows)).collect()
    prints = [slow_fingerprint(t) for _, t in rows]
    ids = [2**63 - 1 if d is None else d for d, _ in rows]
    assert Counter((r.order_id, r.fp % 2**64) for r in got) == Counter(zip(ids, prints, strict=True))
    component = list(range(len(rows)))
    for _ in rows:
        for i, a in enumerate(prints):
            for j, b in enumerate(prints):
                if (a ^ b).bit_count() <= 2:
                    component[i] = component[j] = min(component[i], component[j])
    least = {}
    for i, c in enumerate(component):
        least[c] = min(least.get(c, 2**63), ids[i])
    want = Counter((ids[i], None if least[c] == 2**63 - 1 else least[c]) for i, c in enumerate(component))
    assert Counter((r.order_id, r.component_id) for r in got) == want
    assert simhash.near_duplicates(spark, make([])).count() == 0


def test_simhash_links_any_two_bits(spark):
    fp = 0x0123456789ABCDEF
    other = [fp, *(fp ^ (1 << a) ^ (1 << b) for a, b in ((0, 63), (7, 8), (15, 16), (31, 32), (40, 41)))]
    signed = [(x - 2**64 if x >= 2**63 else x,) for x in other]
    links = simhash.link_edges(spark.createDataFrame(signed, "fp long")).collect()
    assert {(min(a, b), max(a, b)) for a, b in links} >= {(min(signed[0][0], s[0]), max(signed[0][0], s[0])) for s in signed[1:]}


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 100), (200, 201), (201, 200), (None, 5), (300, 40)]
    got = {r.node: r.component for r in connected_components(spark, spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**dict.fromkeys([*range(41), 300], 0), 200: 200, 201: 200}
    assert connected_components(spark, spark.createDataFrame([], "a long, b long")).count() == 0


def test_decontamination(spark, make):
    items = spark.createDataFrame(
        [(1, "Alpha beta gamma delta epsilon zeta eta theta iota kappa"), (2, "two words"), (3, None), (4, "?!"), (1, "Alpha beta gamma delta epsilon zeta eta theta iota kappa")],
        "item_id long, text string",
    )
    text = "alpha BETA gamma, delta epsilon zeta eta theta iota kappa"
    rows = [(1, prose(5000) + " " + text), (2, text.replace("kappa", "x")), (3, text.replace("zeta", "x")), (4, "has two words inside"), (5, None), (6, ""), (None, text), (7, text), (7, text)]
    got = decontamination.contaminated(spark, make(rows), items).collect()
    assert sorted((r.doc_id or -1, r.item_id, r.shared, r.total) for r in got) == [(-1, 1, 6, 6), (1, 1, 6, 6), (2, 1, 5, 6), (4, 2, 1, 1), (7, 1, 6, 6)]
    assert decontamination.contaminated(spark, make([]), items).count() == 0
    assert decontamination.contaminated(spark, make(rows), items.limit(0)).count() == 0


def test_sketch_is_certain_to_hit():
    for n in range(1, 300):
        assert decontamination.sketch_size(n, 0.8) == n or decontamination.sketch_size(n, 0.8) > decontamination.allowed_missing(n, 0.8)


def test_language_id(spark):
    english, german = "the cat sat on the mat and then ", "der hund und die katze sind nicht "
    rows = [(i, english * 3, "en") for i in range(8)] + [(20 + i, german * 3, "de") for i in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.train(docs)
    assert model.languages == ("de", "en")
    probe = spark.createDataFrame(
        [(1, "the mat", "zz"), (2, "und die katze", None), (3, None, None), (4, "", None), (5, "123 !", None), (None, english * 40_000, None), (1, "the mat", "zz")],
        "doc_id long, text string, lang string",
    )
    clashing = probe.selectExpr("*", "1 AS score", "'x' AS verdict", "'y' AS lang_pred", "'z' AS has_letter")
    got = [(r.doc_id, r.lang_pred) for r in language_id.identify(spark, clashing, model).collect()]
    assert Counter(got) == Counter([(1, "en"), (2, "de"), (3, "und"), (4, "und"), (5, "und"), (None, "en"), (1, "en")])
    assert language_id.score(model, "the mat")[0] == "en"
    empty = language_id.train(docs.limit(0))
    assert {r.lang_pred for r in language_id.identify(spark, probe, empty).collect()} == {"und"}
    assert language_id.identify(spark, probe.limit(0), model).count() == 0
    # A tie goes to the language that sorts first.
    even = language_id.train(spark.createDataFrame([("same words", "b"), ("same words", "a")], "text string, lang string"))
    assert {(r.lang_pred, round(r.score, 6)) for r in language_id.identify(spark, probe.where("doc_id = 1"), even).collect()} == {("a", 0.5)}


def test_language_counts_are_whole(spark, monkeypatch):
    """Counts of lower-cased n-grams by hand, across slices and with few languages held at a time."""
    monkeypatch.setattr(language_id, "SLICE", 7)
    monkeypatch.setattr(language_id, "HELD_LANGUAGES", 2)
    texts = ["İstanbul'da BİR gün " * 3, "Grüße aus Köln", "a"]
    for text in texts:
        codes = language_id._codes(text.lower())
        whole = Counter(int(g) for grams in language_id._grams(codes) for g in grams)
        assert Counter(int(g) for grams in language_id._slices(text) for g in grams) == whole
    rows = [(t, f"l{i}") for t in texts for i in range(5)]
    model = language_id.train(spark.createDataFrame(rows, "text string, lang string").coalesce(1))
    assert model.languages == tuple(f"l{i}" for i in range(5))
    assert np.allclose(model.log_likelihood, model.log_likelihood[0]) and np.allclose(model.log_prior, np.log(0.2))


def test_too_many_languages_are_refused_before_texts_are_read(spark, monkeypatch):
    monkeypatch.setattr(language_id, "_count", lambda batches: 1 / 0)
    many = spark.range(language_id.MAX_LANGUAGES + 1).selectExpr("'a' AS text", "concat('l', id) AS lang")
    with pytest.raises(ValueError, match="languages"):
        language_id.train(many)


def quality_rows(seed):
    """Prose and junk from a generator of the test's own."""
    own = random.Random(seed)
    words = lambda n: " ".join(own.choice(VOCAB) for _ in range(n))
    rows = [(i, words(40)) for i in range(120)] + [(200 + i, "$$$ ### " * 20) for i in range(40)] + [(None, None), (300, ""), (0, words(40))]
    return rows, [(i, 1) for i in range(60)] + [(200 + i, 0) for i in range(20)] + [(None, 1), (5, None)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_quality(spark, make, seed):
    rows, known = quality_rows(seed)
    labels = spark.createDataFrame(known, "doc_id long, quality int")
    scored, _ = quality.score_quality(spark, make(rows), labels)
    score = {r.doc_id: r.score for r in scored.collect()}
    assert scored.count() == len(rows) and all(0 <= s <= 1 for s in score.values())
    wins = [score[i] > score[200 + j] for i in range(120) for j in range(40)]
    assert sum(wins) / len(wins) > 0.98
    if seed == 1:
        plain, _ = quality.score_quality(spark, make(rows), labels.limit(0))
        assert {r.score for r in plain.collect()} == {0.5}
        assert quality.score_quality(spark, make([]), labels)[0].count() == 0


def test_quality_weights_minimise_the_risk(spark):
    """The fitted weights against the risk written out plainly, its slope by differences."""
    own = np.random.default_rng(5)
    n = 400
    table = own.normal(size=(n, len(quality.FIGURES)))
    good = table[:, 0] + 0.5 * table[:, 1] + own.normal(size=n) > 0
    trusted = good & (own.random(n) < 0.5)
    rows = spark.createDataFrame([(*map(float, t), bool(p)) for t, p in zip(table, trusted, strict=True)], ", ".join(f"{f} double" for f in quality.FIGURES) + ", trusted boolean")
    edges = quality.bin_edges(rows, n)
    x = quality._design(table, edges)
    prior = 0.5

    def parts(w):
        z = x @ w
        loss_1, loss_0 = np.logaddexp(0, -z), np.logaddexp(0, z)
        return prior * loss_1[trusted].mean(), loss_0.mean() - prior * loss_0[trusted].mean()

    risk = lambda w: parts(w)[0] + max(0.0, parts(w)[1])
    penalty = quality.RIDGE + quality.RIDGE_ROWS / n
    weights = quality.fit(rows, edges, prior)
    assert risk(weights) < risk(np.zeros(quality.SIZE)) - 0.05
    if parts(weights)[1] > 0.01:
        for i in np.flatnonzero(np.abs(weights) > 0.1)[:20]:
            e = np.zeros(quality.SIZE)
            e[i] = 1e-4
            slope = (risk(weights + e) - risk(weights - e)) / 2e-4 + penalty * weights[i]
            assert abs(slope) < 5e-3
    z = x @ weights
    assert (z[good].mean() - z[~good].mean()) > 0.5


def test_class_prior_needs_no_negatives():
    """Where some bins hold positives alone or nearly so, their share tells the prior."""
    own = np.random.default_rng(6)
    for share in (0.2, 0.5, 0.9):
        good = own.random(20_000) < share
        table = own.normal(size=(len(good), len(quality.FIGURES)))
        table[:, 0] += np.where(good, 2.0, -2.0)
        trusted = good & (own.random(len(good)) < 0.3)
        x = quality._design(table, [np.quantile(table[:, i], quality.QUANTILES) for i in range(len(quality.FIGURES))])
        found = quality.class_prior(len(good), x.sum(axis=0), trusted.sum(), x[trusted].sum(axis=0))
        assert abs(found - share) < 0.1


def test_token_counts(spark, make, monkeypatch):
    rows = [(1, "Hello  world\n\n x"), (2, None), (3, ""), (4, "a<|endoftext|>b <|endoftext|>"), (5, "don't  \t'll 漢字 ünï 😀 12345 ---"), (5, " "), (None, prose(3000)), (6, "x" * 3000)]
    tool = Tokenizer.from_file(TOKENIZER)
    want = Counter((d, len((t or "").encode()), len(tool.encode(t or "", add_special_tokens=False).ids)) for d, t in rows)
    got = token_counts.count_tokens(make(rows), TOKENIZER, 1024).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_tokens) for r in got) == want
    assert all(r.over_limit == (r.n_tokens > 1024) for r in got)
    monkeypatch.setattr(token_counts, "CHUNK", 5)
    counter = token_counts.Counter(TOKENIZER)
    assert all(counter.count(t) == len(tool.encode(t or "", add_special_tokens=False).ids) for _, t in rows)
    assert token_counts.count_tokens(make([]), TOKENIZER, 1024).count() == 0


def test_segmentations(spark, make):
    rows = [(1, "the cat"), (2, None), (3, ""), (4, "  x  漢字 😀\n\ty "), (5, "a"), (5, "a"), (None, prose(2000))]
    got = segmentation.sample_segmentations(make(rows), PIECES, 3, 1).collect()
    texts = {d: t or "" for d, t in rows}
    seen = Counter((r.doc_id, tuple(r.ids)) for r in got)
    assert all(r.decoded == texts[r.doc_id] and 0 <= r.inclusion <= 1 and r.log_prob <= 0 for r in got)
    assert all(n == (2 if d == 5 else 1) for (d, _), n in seen.items())
    assert {r.doc_id: r.draw for r in got if not texts[r.doc_id]} == {2: 0, 3: 0}
    again = segmentation.sample_segmentations(make(rows).repartition(5), PIECES, 3, 1).collect()
    assert Counter((r.doc_id, r.draw, tuple(r.ids)) for r in got) == Counter((r.doc_id, r.draw, tuple(r.ids)) for r in again)
    assert segmentation.sample_segmentations(make([]), PIECES, 3).count() == 0


def test_segmentation_draws_follow_the_lattice():
    lattice = segmentation.Lattice(segmentation.vocabulary(public_tokenizers.path("piece_bpe_32k.model")))
    keys = np.array([segmentation.row_key(s, 0, "the cat") for s in range(3000)], np.uint64)
    share, draws = {}, [Counter(), Counter()]
    for _, draw, ids, log_prob, _, _ in segmentation.Search(["the cat"] * 3000, keys, 2, lattice).results():
        share[tuple(ids)] = np.exp(log_prob)
        draws[draw][tuple(ids)] += 1
    assert sum(share.values()) == pytest.approx(1, abs=0.01)
    for path, p in share.items():
        second = sum(share[q] * p / (1 - share[q]) for q in share if q != path)
        assert draws[0][path] / 3000 == pytest.approx(p, abs=0.04)
        assert draws[1][path] / 3000 == pytest.approx(second, abs=0.04)


def test_url_filter_takes_long_hosts(spark):
    """A host of 100,000 labels: only the endings that a rule could name are made."""
    long = ".".join(["a"] * 100_000)
    pages = spark.createDataFrame([(1, f"http://{long}.Example.com/x", None), (2, f"http://{long}/", "")], "page_id long, url string, html string")
    rules = spark.createDataFrame([("example.com", "/", "block"), ("org", "/fr/", "allow")], "host string, path string, action string")
    got = {r.page_id: (r.rule, r.verdict) for r in url_filter.judge(spark, pages, rules).collect()}
    assert got == {1: ("example.com/", "block"), 2: (None, "allow")}
    assert url_filter.judge(spark, pages, rules.limit(0)).count() == 2


def test_url_filter(spark):
    link = '<link rel="canonical" href="{}">'
    pages = spark.createDataFrame(
        [
            (1, "HTTP://A.Example.NET/en/x?q#f", None, "h"), (2, "https://b.net/en/", "", "h"), (3, None, link.format("http://b.net/p"), "h"),
            (4, "no scheme", None, "h"), (5, "http://c.org/a", link.format("http://bad.net/z"), "h"), (6, "http://d.org/b", '<meta http-equiv="refresh" content="0; url=http://c.org/a">', "h"),
            (7, "http://example.org/fr/1", link.format("//bad.net/z"), "h"), (8, "http://notnet/", None, "h"), (9, "http://e.org/k", link.format("/l"), "h"), (5, "http://c.org/a", link.format("http://bad.net/z"), "h"),
        ],
        "page_id long, url string, html string, rule string",
    )
    rules = spark.createDataFrame([("net", "/", "block"), ("example.net", "/en/", "allow"), ("org", "/fr/", "allow")], "host string, path string, action string")
    moved = spark.createDataFrame([("http://m.org/1", "http://e.org/l"), ("http://m.org/1", "http://x.net/")], "source string, target string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(spark, pages, rules, moved).collect()}
    assert got == {
        1: ("a.example.net", "/en/x", "example.net/en/", "allow"), 2: ("b.net", "/en/", "net/", "block"), 3: ("", "", None, "allow"), 4: ("", "", None, "allow"),
        5: ("c.org", "/a", None, "block"), 6: ("d.org", "/b", None, "block"), 7: ("example.org", "/fr/1", "org/fr/", "allow"), 8: ("notnet", "/", None, "allow"), 9: ("e.org", "/k", None, "block"),
    }
    assert url_filter.judge(spark, pages.limit(0), rules).count() == 0


def test_tasks_leave_no_caches_in_their_workers(spark, make):
    def left(batches):
        import pyarrow as pa

        from contactflow.llm import decontamination, segmentation

        for _ in batches:
            yield pa.RecordBatch.from_pydict({"n": pa.array([len(decontamination.HASHES) + len(segmentation.LATTICES)], pa.int64())})

    docs = make([(i, prose(30)) for i in range(40)]).repartition(4)
    decontamination.contaminated(spark, docs, spark.createDataFrame([(1, prose(8))], "item_id long, text string")).count()
    segmentation.sample_segmentations(docs, PIECES, 2).collect()
    assert max(r.n for r in spark.range(0, 64, 1, 16).mapInArrow(left, "n long").collect()) == 0


def test_registered_queries_and_pipeline(spark, sf_dir):
    import __spark_entry__ as entry_point
    import corpus_pipeline

    names = set(entry_point.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    odd = docs.limit(30).union(docs.limit(2)).union(spark.createDataFrame([(None, "a b c d e f", None, None, None), (10**9, None, "en", "s", 1)], docs.schema))
    rows = odd
    for _, stage in corpus_pipeline.STAGES[:-1]:
        before, rows = rows.count(), stage(spark, rows, sf_dir)
        assert rows.columns == docs.columns and rows.count() <= before
        none = stage(spark, docs.limit(0), sf_dir)
        assert none.columns == docs.columns and none.count() == 0
    assert rows.select("doc_id").distinct().count() == rows.count()
    assert corpus_pipeline.STAGES[-1][1](spark, rows, sf_dir).select("doc_id").distinct().count() == rows.count()
