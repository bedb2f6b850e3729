"""Source divergence, byte repeats and fill-in-middle against plain re-computations."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from llm_data import as_docs
from minekit.llm import divergence, fim, repeats

# ---------------------------------------------------------------- source divergence


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(min_size=1, max_size=40).map(lambda b: bytes(97 + x % 3 for x in b)), min_size=1, max_size=200), st.sampled_from([1, 4, 4096]))
def test_pointer_sort_orders_words_and_numbers_runs(words, small):
    raw = np.frombuffer(b" ".join(words), np.uint8)
    starts, lengths = divergence.word_pointers(raw, np.array([0, len(raw)]))
    sort = divergence.PointerSort(raw, starts, lengths, small)
    found = [bytes(raw[starts[p]:starts[p] + lengths[p]]) for p in sort.order]
    assert found == sorted(words)
    assert [a == b for a, b in zip(found, found[1:])] == [a == b for a, b in zip(sort.run, sort.run[1:])]


def test_words_do_not_reach_across_texts():
    raw = np.frombuffer("abécd ".encode(), np.uint8)
    starts, lengths = divergence.word_pointers(raw, np.array([0, 2, len(raw), len(raw)]))
    assert [bytes(raw[s:s + n]).decode() for s, n in zip(starts, lengths)] == ["ab", "écd"]
    assert len(divergence.word_pointers(np.empty(0, np.uint8), np.array([0]))[0]) == 0


def plain_divergence(rows, min_docs, top):
    term = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    docs, counts, groups = Counter(), defaultdict(Counter), set()
    for _, text, lang, source in rows:
        words = [w.translate(fold) for w in term.findall(text or "")]
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        counts[lang, source].update(words)
        docs.update((lang, w) for w in set(words))
    out = []
    for lang, source in groups:
        kept = [w for (g, w), n in docs.items() if g == lang and n >= min_docs]
        whole = sum((counts[g] for g in groups if g[0] == lang), Counter())

        def share(c):
            under = sum(c[w] for w in kept) + 5 * len(kept)
            return {w: 1 + 10**9 * (c[w] + 5) // under for w in kept}

        own, q = share(counts[lang, source]), share(whole)
        pairs = [(-sum(abs(own[w] - other[w]) for w in kept), s.encode(), s)
                 for g, s in groups if g == lang and s != source for other in [share(counts[g, s])]]
        terms = [(q[w] - own[w], w.encode(), w) for w in kept if counts[lang, source][w] and own[w] > q[w]]
        for part, items in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
            out += [(lang, source, part, name, -value, i + 1) for i, (value, _, name) in enumerate(items)]
    return sorted(out)


@pytest.mark.parametrize("block", [256, 2])
def test_divergence_equals_plain(spark, monkeypatch, block):
    monkeypatch.setattr(divergence, "BLOCK", block)
    draw = random.Random(3)
    words = [f"{a}{b}" for a in ("Über", "a", "zeta", "lengthyword", "x-y") for b in ("", "b", "CD", "é")]
    rows = [(i, " ".join(draw.choice(words[: draw.randint(2, len(words))]) for _ in range(draw.randint(0, 40))),
             draw.choice(["en", "de", None]), draw.choice(["s1", "s2", "S3", None, "ü"])) for i in range(150)]
    rows += [(None, None, None, "s1"), (5, "", "xx", "only"), (6, "", "xx", "other"), (7, "rare", "yy", "one"), (7, "rare", "yy", "one")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    df = df.select("*", *[F.lit(None).cast("string").alias(c) for c in ("term", "n", "docs", "part", "item", "index", "p", "a")])
    found = sorted(tuple(r) for r in divergence.divergence(df, min_docs=12, top=4).collect())
    assert found == plain_divergence(rows, 12, 4)


def test_divergence_of_nothing(none):
    assert divergence.divergence(none).count() == 0


def test_divergence_of_messy_rows(messy):
    found = divergence.divergence(messy, min_docs=2)
    assert {r.lang for r in found.select("lang").collect()} <= {"", "en", "de", "fr", "es"}
    assert found.where("part = 'pair'").count() == 0  # one source only


# ---------------------------------------------------------------- byte repeats


def plain_repeats(rows, window):
    """Rows of (id, text) in order; equal rows count once."""
    seen, out = set(), {}
    for id, text in rows:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - window + 1):
            part = raw[i:i + window]
            if part in seen:
                gone[i:i + window] = b"\1" * window
            seen.add(part)
        spans = [(m.start(), m.end()) for m in re.finditer(b"\1+", bytes(gone))]
        out[id, text] = (len(raw), sum(gone), spans, bytes(b for b, g in zip(raw, gone) if not g))
    return out


def found_repeats(df, **given):
    return [(r.doc_id, r.n_bytes, r.n_removed, [(s.begin, s.end) for s in r.spans], bytes(r.kept)) for r in repeats.without_repeats(df, **given).collect()]


def repeating_rows():
    draw = random.Random(9)
    prose = lambda n: "".join(draw.choice("abcdefgh ijé\n") for _ in range(n))
    common, base = prose(300), prose(2500)
    rows = [(i, prose(draw.randint(0, 200)) + common[draw.randint(0, 90):] + prose(120)) for i in range(60)]
    rows += [(100, base), (101, base), (102, base[:1200] + "CHANGED" + base[1200:]), (103, base[700:]), (104, "ab" * 900), (105, "x" * 700),
             (106, "Sich " * 60 + prose(50)), (107, "Sich " * 90), (108, None), (109, ""), (110, prose(99)), (111, "é" * 300), (-4, base[:400])]
    return rows


@pytest.mark.parametrize("given", [{}, {"bucket": 20, "hot": 8}, {"bucket": 1, "hot": 1}])
def test_repeats_equal_plain(spark, given):
    rows = repeating_rows()
    df = as_docs(spark, [(i, t, "en") for i, t in rows]).repartition(5)
    want = plain_repeats(sorted(rows), 100)
    assert sorted(found_repeats(df, **given)) == sorted((i, *v) for (i, _), v in want.items())


def test_repeated_rows_and_missing_ids(spark):
    draw = random.Random(1)
    base = "".join(draw.choice("abcdef ") for _ in range(400))
    rows = [(None, base, "en"), (1, base + "x", "en"), (2, "y" + base, "en"), (2, "y" + base, "en"), (3, base, "en"), (3, base, "en")]
    found = sorted(found_repeats(as_docs(spark, rows).repartition(3)), key=str)
    # The null id is the earliest; rows that share id and text get one answer.
    assert found == sorted([(None, 400, 0, [], base.encode()), (1, 401, 400, [(0, 400)], b"x"), *[(2, 401, 400, [(1, 401)], b"y")] * 2,
                            *[(3, 400, 400, [(0, 400)], b"")] * 2], key=str)


def test_repeats_of_messy_rows(messy, none):
    found = found_repeats(messy)
    assert len(found) == messy.count()
    assert all(n == removed + len(kept) for _, n, removed, _, kept in found)
    assert found_repeats(none) == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("ab", min_size=8, max_size=40), min_size=1, max_size=20), st.integers(8, 12))
def test_transform_sorts_suffixes_and_tells_equal_windows(pieces, window):
    pieces = [p.encode() for p in pieces if len(p) >= window] or [b"a" * window]
    made = repeats.CollectionTransform(pieces, window)
    joined, ends = b"".join(pieces), np.cumsum([len(p) for p in pieces])
    held = [joined[s:ends[np.searchsorted(ends, s, "right")]] for s in made.suffix[len(pieces):].tolist()]
    assert held == sorted(held) and len(held) == len(joined)
    for i in range(1, len(held)):
        if min(len(held[i]), len(held[i - 1])) >= window:
            assert made.equal[len(pieces) + i] == (held[i][:window] == held[i - 1][:window])
    before = [joined[s - 1] if s not in (0, *ends.tolist()) else None for s in made.suffix[len(pieces):].tolist()]
    letters = sorted(set(joined))
    assert [letters[t - 1] if t else None for t in made.transform[len(pieces):].tolist()] == before


def test_every_window_is_in_one_piece_and_equal_windows_share_keys():
    draw = random.Random(2)
    texts = [bytes(draw.choice(b"abcd") for _ in range(draw.randint(0, 700))) for _ in range(20)] + [b"xy" * 400, b"z" * 99, b"z" * 100]
    for level in (0, 1, 2):
        which, start, windows, key, _ = repeats.pieces_of(texts, 100, level)
        place = Counter((i, s) for i, a, n in zip(which.tolist(), start.tolist(), windows.tolist()) for s in range(a, a + n))
        assert place == Counter((i, s) for i, t in enumerate(texts) for s in range(len(t) - 99))
        keys = {}
        for i, a, n, k in zip(which.tolist(), start.tolist(), windows.tolist(), key.tolist()):
            assert all(keys.setdefault(texts[i][s:s + 100], k) == k for s in range(a, a + n))


# ---------------------------------------------------------------- fill-in-middle

UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]", re.S)


def plain_fim(id, text):
    text = text or ""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"1:{'' if id is None else id}".encode()).hexdigest()
    h = [int(digest[i:i + 8], 16) for i in (0, 8, 16, 24)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return len(units), "plain", text, None, None
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    form = "spm" if h[3] % 100 < 20 else "psm"
    out = f"<S>{suffix}<P>{prefix}<M>{middle}" if form == "spm" else f"<P>{prefix}<S>{suffix}<M>{middle}"
    return len(units), form, out, len(prefix), len(middle)


def test_fill_in_middle_equals_plain_and_restores(spark, messy, none):
    draw = random.Random(4)
    shared = "".join(draw.choice("ab cdé😀\n.") for _ in range(5000))
    rows = [(i, "".join(draw.choice(["word", " ", "É", "<P", ">", "\n", "longerword", "😀"]) for _ in range(draw.randint(0, 300))) + shared * (i % 2), "en") for i in range(80)]
    rows += [(500, "a" * 20_000, "en"), (501, "é" * 20_000, "en"), (502, "has <M> inside", "en"), (503, "x", "en")]
    df = as_docs(spark, rows).unionByName(messy)
    found = fim.fill_in_middle(df).withColumn("text", fim.restored(F.col("output"), F.col("form"))).collect()
    assert len(found) == df.count()
    texts = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    assert sorted(((r.doc_id, r.text) for r in found), key=str) == sorted(((i, t or "") for i, t in texts), key=str)
    want = sorted(((i, *plain_fim(i, t)) for i, t in texts), key=str)
    assert sorted(((r.doc_id, r.n, r.form, r.output, r.prefix_chars, r.middle_chars) for r in found), key=str) == want
    assert {r.form for r in found} == {"plain", "psm", "spm"}
    assert fim.fill_in_middle(none).count() == 0


def test_shared_chunks_are_counted_once():
    draw = random.Random(6)
    shared = bytes(draw.choice(b"abc def.") for _ in range(30_000))
    cache = fim.ChunkCache()
    for lead in (b"one ", b"another one"):
        text = lead + shared
        counted = fim.Counted(text, fim.chunk_ends(text, fim.candidates(np.frombuffer(text, np.uint8)).tolist()), cache)
        units = UNIT.findall(text.decode())
        assert counted.tokens == len(units)
        for token in (0, 1, 2, len(units) // 2, len(units) - 1, len(units)):
            assert counted.start_of(token) == (len("".join(units[:token])),) * 2
        if lead == b"one ":
            first = cache.made
    assert cache.made - first < 10 < first


def test_the_cache_is_bounded_and_tells_contents_apart():
    cache = fim.ChunkCache(most=1000)
    for i in range(500):
        assert cache[b"word %d" % i].chars == len("word %d" % i)
        assert cache.size <= 1100 and len(cache.young) + len(cache.old) < 400


@settings(max_examples=80, deadline=None)
@given(st.text("aZé😀 \n.", max_size=400), st.integers(1, 40), st.data())
def test_any_cut_of_a_text_counts_alike(text, step, data):
    raw, units = text.encode(), UNIT.findall(text)
    ends = [e for e in range(step, len(raw), step) if raw[e] & 0xC0 != 0x80] + [len(raw)] * bool(raw)
    counted = fim.Counted(raw, ends, fim.ChunkCache())
    assert counted.tokens == len(units)
    token = data.draw(st.integers(0, len(units)))
    before = "".join(units[:token])
    assert counted.start_of(token) == (len(before), len(before.encode()))


def test_symbols_are_counted_from_the_nearer_end_of_a_leaf(monkeypatch):
    """The transform of pieces with long leaves is the last column of their sorted suffixes."""
    draw = np.random.default_rng(3)
    pieces = [bytes(draw.integers(97, 100, int(draw.integers(8, 30))).astype(np.uint8)) for _ in range(40)]
    monkeypatch.setattr(repeats, "LEAF", 16)
    monkeypatch.setattr(repeats, "MOST_IN_LEAF", 24)
    widths = []
    real = np.packbits
    monkeypatch.setattr(repeats.np, "packbits", lambda a, **k: widths.append(a.shape[1]) or real(a, **k))
    made = repeats.CollectionTransform(pieces, 8)
    joined = sorted((p[i:], n, p[i - 1:i]) for n, p in enumerate(pieces) for i in range(len(p) + 1))
    assert len(made.transform) == len(joined)
    assert max(widths) <= 12  # the whole leaf before
    symbols = {0: b"", **{n + 1: bytes([c]) for n, c in enumerate(sorted(set(b"".join(pieces))))}}
    suffixes = [b"".join(pieces)[s:] for s in made.suffix.tolist()]
    ends = np.cumsum([len(p) for p in pieces])
    own = [x[:e - s] for x, s, e in zip(suffixes, made.suffix.tolist(), ends[np.searchsorted(ends, made.suffix, "right").clip(0, len(pieces) - 1)].tolist())]
    long = [i for i, (text, _, _) in enumerate(joined) if len(text) >= 8]
    assert [own[i][:8] for i in long] == [joined[i][0][:8] for i in long]
    assert sorted(symbols[c] for c in made.transform.tolist()) == sorted(p for _, _, p in joined)
