"""SimHash, packing, token counts, order MinHash, WARC and the pipeline against brute force."""

import hashlib
import itertools
import json
import random
import re
import zlib
from pathlib import Path

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import xxhash
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from llm_data import as_docs, messy_rows
from minekit.llm import orderhash, packing, simhash, tokens, warc

WORDS = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


# ------------------------------------------------------------------ SimHash

def brute_print(text, shingle=4):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + shingle]).encode(), 42) for i in range(max(1, len(words) - shingle + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """Root of every value among those linked by at most four bits."""
    values = sorted(set(prints))
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for a, b in itertools.combinations(values, 2):
        if (a ^ b).bit_count() <= 4:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {v: find(v) for v in values}


def near_values(seed=4, centres=12, each=25):
    draw = random.Random(seed)
    out = [0, (1 << 64) - 1, 1, 3, 7, 1 << 63]
    for _ in range(centres):
        value = draw.getrandbits(64)
        for _ in range(each):
            out.append(value)
            for bit in draw.sample(range(64), draw.randint(1, 5)):
                value ^= 1 << bit
    return out


def signed(value):
    return value - (1 << 64) if value >> 63 else value


@pytest.mark.parametrize("group", [simhash.GROUP, 3])
def test_links_connect_what_brute_force_connects(spark, group):
    values = near_values()
    frame = spark.createDataFrame([(signed(v),) for v in values * 2], "fingerprint long")
    roots = {r.node: r.root for r in simhash.components(simhash.links(frame, group)).collect()}
    got = {}
    for v in values:
        got.setdefault(roots.get(signed(v), signed(v)), set()).add(v)
    want = {}
    for v, r in brute_components(values).items():
        want.setdefault(r, set()).add(v)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


@given(st.integers(0, 2**64 - 1), st.sets(st.integers(0, 63), max_size=4))
@settings(max_examples=300, deadline=None)
def test_some_chain_keeps_its_budgets(value, bits):
    difference = np.array([sum(1 << b for b in bits)], np.uint64)
    assert any(simhash.in_chain(difference, start)[0] for start in range(5))


def test_near_duplicates_equal_brute_force(spark, messy):
    rows = messy_rows()
    prints = [brute_print(t) for _, t, _ in rows]
    roots = brute_components(prints)
    least = {}
    for (i, *_), p in zip(rows, prints):
        if i is not None:
            least[roots[p]] = min(i, least.get(roots[p], i))
    want = sorted((str(i), f"{p:016x}", str(least.get(roots[p]))) for (i, *_), p in zip(rows, prints))
    got = sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in simhash.near_duplicates(messy).collect())
    assert got == want


def test_one_of_each_group_stays(spark, messy, none):
    out = simhash.without_near_duplicates(messy)
    ids = [r.doc_id for r in out.collect()]
    assert out.columns == messy.columns
    assert {6, None, 1} <= set(ids) and not {2, 3, 7} & set(ids) and len(ids) == len(set(ids))
    assert simhash.without_near_duplicates(none).count() == 0 and simhash.near_duplicates(none).count() == 0


def test_components_of_a_long_path(spark):
    edges = spark.range(60).select(F.col("id").alias("b"), (F.col("id") + 1).alias("a"))
    assert {r.root for r in simhash.components(edges).collect()} == {0}


# ------------------------------------------------------------------ packing

def test_best_fit_equals_a_plain_search():
    draw = random.Random(1)
    for capacity in (1, 2, 7, 16, 100):
        lengths = sorted((draw.randint(1, capacity) for _ in range(200)), reverse=True)
        room, want = [], []
        for n in lengths:
            fits = [(left, w) for w, left in enumerate(room) if left >= n]
            left = min(fits)[0] if fits else capacity
            want.append(left)
            if fits:
                room[min(fits)[1]] -= n
            else:
                room.append(capacity - n)
        placed, seen, got = packing.best_fit(lengths, capacity), {}, []
        for n, w in zip(lengths, placed):
            got.append(seen.get(w, capacity))
            seen[w] = got[-1] - n
        assert got == want and min(seen.values()) >= 0


def check_packed(rows, found, window, end=1):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(WORDS)
    ids = [np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [end], "<u4") for _, t, _ in rows]
    pieces = {}
    for r in found:
        pieces.setdefault((r.doc_id, r.doc_tokens), []).append(r)
    want = {}
    for (i, *_), x in zip(rows, ids):
        want.setdefault((i, len(x)), []).append(x)
    assert set(pieces) == set(want)
    for key, own in pieces.items():
        assert sum(r.length for r in own) == sum(map(len, want[key]))
        if len(want[key]) == 1:
            own.sort(key=lambda r: r.start)
            assert [r.start for r in own] == list(np.cumsum([0, *(r.length for r in own)])[:-1])
            assert all(zlib.crc32(want[key][0][r.start:r.start + r.length].tobytes()) == r.ids_crc32 for r in own)
    sequences = {}
    for r in found:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in sequences.values():
        own.sort()
        assert [o for o, _ in own] == list(np.cumsum([0, *(n for _, n in own)])[:-1]) and sum(n for _, n in own) <= window
    return [sum(n for _, n in own) for own in sequences.values()]


@pytest.mark.parametrize("window,group", [(2048, 20_000), (64, 4), (10, 3)])
def test_packing_is_an_exact_cover(spark, messy, window, group):
    found = packing.pack(messy, WORDS, window=window, group=group).collect()
    check_packed(messy_rows(), found, window)


def test_packing_pads_little_where_all_documents_are_alike(spark):
    docs = as_docs(spark, [(i, "word " * 1200, "en") for i in range(50)])
    filled = check_packed([(i, "word " * 1200, "en") for i in range(50)], packing.pack(docs, WORDS).collect(), 2048)
    padding = sum(0 if n & (n - 1) == 0 else 2048 - n for n in filled)
    assert padding < 0.05 * sum(filled)


def test_packing_of_an_empty_table(none):
    assert packing.pack(none, WORDS).count() == 0


@given(st.lists(st.sampled_from(["a", "É", "é", "ß", "Σ", "ς", "İ", " ", "\t", "\x85", "\xa0", " ", "\x1c", "'s", "12", "…", "<|endoftext|>", "漢", "\x00"])))
@settings(max_examples=300, deadline=None)
def test_words_tokenise_like_whole_texts(parts):
    text = "".join(parts)
    cache = _cache()
    texts = [text, None, "the " + text, ""]
    assert [x.tolist() for x in cache.ids_of(texts)] == [cache.whole(t or "") for t in texts]


def test_long_texts_are_encoded_in_parts(monkeypatch):
    cache = _cache()
    texts = ["ab cd\n" * 20, "x", "y" * 50, " " * 40, "é ü" * 9, None]
    monkeypatch.setattr(packing, "_AT_ONCE", 16)
    assert [x.tolist() for x in cache.ids_of(texts)] == [cache.whole(t or "") for t in texts]


@given(st.lists(st.sampled_from([
    "a", "ll", "S", "J", "\u030c", "\u0307", "\u0338", "É", "ÿ", "ß", "×", "÷", "º", "İ", "\u212a", "\u0e31", "漢", "'", "’", ".", "=", "<|", "|>", "_",
    "<|endoftext|>", "<|ENDOFTEXT|>", "endoftext", "7", "٣", "½", " ", "\xa0", "\u2003", "\x1f", "\x7f"])))
@settings(max_examples=600, deadline=None)
def test_cut_words_tokenise_like_whole_texts(parts):
    cache = _cache()
    text = "".join(parts)
    texts = ["a.b", text, "", text + ".", "'" + text]
    assert [x.tolist() for x in cache.ids_of(texts)] == [cache.whole(t) for t in texts]


def test_letters_beside_other_signs_are_encoded_once():
    cache, met = packing.word_encoder(WORDS), []
    encode = cache.encode
    cache.encode = lambda words: met.extend(words) or encode(words)
    texts = [f"{a}{w}{b} {n}" for w in ("bread", "Bread", "BREAD", "crème") for a in "(<\"" for b in ".,;!" for n in range(100, 120)]
    want = _cache().whole
    assert [x.tolist() for x in cache.ids_of(texts)] == [want(t) for t in texts]
    assert sorted(met) == sorted({"bread", "crème", *"(<\".,;!0123456789"})


@pytest.mark.parametrize("change", ["split", "fold", "added"])
def test_words_of_other_tokenizers_are_not_cut(tmp_path, change):
    from tokenizers import Tokenizer

    kind = json.loads(Path(WORDS).read_text())
    if change == "split":
        kind["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] = "\\S+"
    elif change == "fold":
        kind["normalizer"] = None
    else:
        kind["added_tokens"].append(kind["added_tokens"][0] | {"id": 49408, "content": "!!"})
    (path := tmp_path / "other.json").write_text(json.dumps(kind))
    cache, tokenizer = packing.word_encoder(str(path)), Tokenizer.from_file(str(path))
    texts = ["Bread, bread. (it's) 12", "a!!b !!! É.", "<|endoftext|>x"]
    assert cache.special is None
    assert [x.tolist() for x in cache.ids_of(texts)] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def _cache(made=[]):
    if not made:
        from tokenizers import Tokenizer

        made.append(packing.word_encoder(WORDS))
        tokenizer = Tokenizer.from_file(WORDS)
        made[0].whole = lambda text: tokenizer.encode(text, add_special_tokens=False).ids
        made[0].most = 40  # forgets now and then
    return made[0]


# ------------------------------------------------------------------ token counts

def _pieces(made=[]):
    made or made.append(tokens.Pieces(PIECES))
    return made[0]


@given(st.lists(st.sampled_from(["a", "the", " ", "  ", "\n", "é", "漢", "▁", "x.", " idea", "😀", "\t", "zz "]), max_size=150),
       st.sampled_from([(16, 4), (40, 8), (7, 1), (2, 1)]))
@settings(max_examples=400, deadline=None)
def test_spliced_counts_equal_whole_ones(parts, size):
    text = "".join(parts)
    assert tokens.spliced_count(text, _pieces(), *size) == len(_pieces().model.encode(text))


def test_token_counts_of_odd_tables(spark, messy, none):
    model = _pieces().model
    for chunk, overlap in ((tokens.CHUNK, tokens.OVERLAP), (500, 20)):
        found = tokens.token_counts(messy, PIECES, chunk=chunk, overlap=overlap).collect()
        want = [(i, len((t or "").encode()), n := len(model.encode(t or "")), n > 4096) for i, t, _ in messy_rows()]
        assert sorted(map(str, map(tuple, found))) == sorted(map(str, want))
    assert tokens.token_counts(none, PIECES).count() == 0


# ------------------------------------------------------------------ order MinHash

def brute_order_minhash(text):
    """The definition over k-mers, with the engine's 64-bit hashes taken from the DataFrame side."""
    words = [w for w in re.split(r"[ \t\n\x0b\f\r]+", text or "") if w]
    if not words:
        return None
    k = orderhash.KMER
    return [tuple(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]


def test_numbered_kmers_and_slots(spark):
    draw = random.Random(6)
    texts = ["", None, "one", "a a a a a a", "x y x y x y x y", " ".join(draw.choice("abcdefgh") for _ in range(300)),
             " ".join(f"w{i}" for i in range(500))]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    prints = {r.doc_id: r.p for r in frame.select("doc_id", orderhash.order_minhash(F.col("text")).alias("p")).collect()}
    hashes = spark.createDataFrame(
        [(i, at, *g, *[None] * (orderhash.KMER - len(g))) for i, t in enumerate(texts) for at, g in enumerate(brute_order_minhash(t) or [])],
        "doc_id long, at long, a string, b string").withColumn("h", F.xxhash64("a", "b")).toPandas()
    mask = (1 << 34) - 1
    for i, t in enumerate(texts):
        own = hashes[hashes.doc_id == i].sort_values("at")
        if own.empty:
            assert prints[i] == [0] * orderhash.SLOTS
            continue
        # Number occurrences by the upper 34 bits of the hash, then rehash through Spark.
        seen, numbered = {}, []
        for at, h in zip(own["at"], own["h"]):
            upper = int(h) >> 30
            numbered.append((upper, seen.setdefault(upper, 0), int(at)))
            seen[upper] += 1
        again = spark.createDataFrame(numbered, "u long, n int, at long").select("at", F.xxhash64("u", "n").alias("h")).collect()
        bins = {}
        for r in sorted(again, key=lambda r: (r.h >> 30, r.at)):
            bins.setdefault((r.h >> 57) + 64, ((r.h >> 30), r.at))
        groups = {}
        for b, (h, at) in bins.items():
            groups.setdefault(b // orderhash.GROUP, []).append((at, h))
        rows = [(s, [h & mask for _, h in sorted(x)]) for s, x in groups.items()]
        want = {r.s: r.h for r in spark.createDataFrame(rows, "s int, e array<long>").select("s", F.hash("e").alias("h")).collect()}
        assert prints[i] == [want.get(s, 0) for s in range(orderhash.SLOTS)]


def brute_next(rows):
    order = lambda r: (r[0] is None, -(r[0] or 0), r[1] or "")
    texts = [t or "" for _, t, _ in sorted(rows, key=order)]
    ids = [i for i, *_ in sorted(rows, key=order)]
    return [(i, t, texts[(n + 1) % len(texts)]) for n, (i, t) in enumerate(zip(ids, texts))]


@pytest.mark.parametrize("parts", [1, 3, 100])
def test_edits_take_the_next_document(spark, messy, parts):
    got = orderhash.edit_likeness(messy, parts=parts).collect()
    want = []
    for i, t, following in brute_next(messy_rows()):
        half = len(t) // 2
        want.append((i, len(t), hashlib.sha256((t[:len(t) - half] + following[:half]).encode()).hexdigest()))
    assert sorted(map(str, want)) == sorted(str((r.doc_id, r.n_chars, r.edited_sha256)) for r in got)
    prints = {}
    for r in got:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert prints.setdefault((r.doc_id, r.n_chars), r.fingerprint) == r.fingerprint  # equal texts
    by_id = {r.doc_id: r for r in got}
    assert by_id[6].fingerprint == by_id[7].fingerprint and by_id[7].near_next == 1.0 and by_id[5].near_edited > by_id[5].near_next


@pytest.mark.parametrize("ids", ["hashes", "neighbours"])
def test_next_document_of_ids_that_no_double_holds(spark, ids):
    draw = random.Random(9)
    ids = [draw.getrandbits(64) - 2**63 for _ in range(300)] if ids == "hashes" else [2**62 + i for i in range(300)]
    rows = [(i, f"text number {n} " * 3, "en") for n, i in enumerate(ids)]
    docs = as_docs(spark, rows)
    want = sorted((i, t, following) for i, t, following in brute_next(rows))
    for parts in (7, 100):
        got = orderhash.with_next(docs, "doc_id", {"text": F.col("text")}, parts).collect()
        assert sorted((r.doc_id, r.text, r.next.text) for r in got) == want


def test_order_matters_and_single_rows(spark, none):
    a = " ".join(f"w{i}" for i in range(400))
    b = " ".join([f"w{i}" for i in range(200, 400)] + [f"w{i}" for i in range(200)])
    pair = spark.createDataFrame([(a, b)], "a string, b string")
    got = pair.select(orderhash.likeness(orderhash.order_minhash(F.col("a")), orderhash.order_minhash(F.col("b"))).alias("x")).first().x
    assert 0.3 < got < 0.8  # nearly equal sets of k-mers, but half of the pairs change order
    one = orderhash.edit_likeness(as_docs(spark, [(1, "abc def", "en")])).first()
    assert one.edited_sha256 == hashlib.sha256(b"abc abc").hexdigest() and one.near_next == 1.0
    assert orderhash.edit_likeness(none).count() == 0


# ------------------------------------------------------------------ WARC

PAGES = [
    (1, "http://a/", "<title>T &amp; U</title><p>One<br>two <b>three</b></p><script>x<p></script><a href='/q'>L</a>"), (2, None, None),
    (3, "http://b/\r\nX: y", "<p>broken <div <![x <!-- <a href=>z</a> &#99999999; \x00"), (None, "", ""), (1, "http://a/", "<p>" * 5000),
    (5, "http://c/", "plain " * 100_000),
]


def test_derivatives_round_trip(spark):
    pages = spark.createDataFrame([(*p, "x", "y") for p in PAGES], "page_id long, url string, html string, key string, headers string")
    sources = warc.responses(pages)
    origin = {r.headers["WARC-Record-ID"]: r for r in sources.collect()}
    found = warc.derivatives(sources).collect()
    assert len(found) == 2 * len(PAGES)
    ids = {r.record_id for r in found}
    for r in found:
        headers, block = warc.parse(r.record)
        assert block == r.block and headers["WARC-Block-Digest"] == warc.digest(block) and int(headers["Content-Length"]) == len(block)
        source = origin[headers["WARC-Refers-To"]]
        assert headers["WARC-Source-Payload-Digest"] == warc.digest(bytes(source.payload)) and headers["WARC-Date"] == source.headers["WARC-Date"]
        assert set(headers) == set(dict(r.headers)) and r.refers_to == headers["WARC-Refers-To"]
        if r.warc_type == "metadata":
            fields = dict(line.split(": ", 1) for line in block.decode().split("\r\n") if ": " in line)
            assert fields["conversion"] in ids and fields["source-WARC-Record-ID"] == r.refers_to
    first = {r.warc_type: r for r in found if r.refers_to == warc.derivatives(sources.limit(1)).first().refers_to}
    assert bytes(first["conversion"].block) == b"One\ntwo three\nL" and b"title: T & U\r\n" in first["metadata"].block
    assert b"outlink: /q\r\n" in first["metadata"].block


def test_derivatives_of_given_headers(spark):
    rows = [("k", {"WARC-Record-ID": "<urn:uuid:1>", "WARC-Date": "2020-01-01T00:00:00Z", "WARC-IP-Address": "1.2.3.4",
                   "WARC-Payload-Digest": "sha1:X", "WARC-Block-Digest": "sha1:Y", "Content-Type": "text/html; charset=latin-1"},
             bytearray("<p>é".encode("latin-1"))), ("l", None, None)]
    sources = spark.createDataFrame(rows, "key string, headers map<string,string>, payload binary")
    found = {(r.key, r.warc_type): r for r in warc.derivatives(sources).collect()}
    conversion, metadata = found["k", "conversion"], found["k", "metadata"]
    assert bytes(conversion.block).decode() == "é" and "WARC-IP-Address" not in conversion.headers
    assert metadata.headers["WARC-IP-Address"] == "1.2.3.4" and metadata.headers["WARC-Source-Block-Digest"] == "sha1:Y"
    assert metadata.headers["WARC-Source-Payload-Digest"] == "sha1:X" and found["l", "conversion"].block == b""
    assert warc.derivatives(sources.limit(0)).count() == 0


@pytest.mark.parametrize("end", ["<![foo[bar", "<![foo[bar]]>", "<![", "<![ [x", "<![CDATA[x", "<!x"])
def test_unknown_marked_sections_are_skipped(end):
    assert warc.read_page(f"<title>t</title><p>a</p>{end}").text.split("\n")[0] == "a"
    assert warc.read_page(f"<p>a</p>{end}><p>b</p>").parts[0] == "\n"


@given(st.text(alphabet="<>!-/[]&#;x1\"' =ap\n", max_size=200))
@settings(max_examples=300, deadline=None)
def test_any_markup_is_read(markup):
    warc.read_page(markup).text


# ------------------------------------------------------------------ pipeline

def test_pipeline_stages_on_the_smallest_tables(spark, tmp_path):
    """Each stage against what its predecessor kept, judged by plain Python."""
    from test_filters import judged, kept_lines

    folder = "/root/testdata/sf0.001"
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    before = None
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_duplicates", "decontamination", "packing"]
    for name, stage in corpus_pipeline.STAGES:
        old = [tuple(r) for r in docs.collect()]
        stage(spark, docs, folder).write.parquet(str(tmp_path / name))
        before, docs = docs, spark.read.parquet(str(tmp_path / name))
        if name == "packing":
            assert max(check_packed([r[:3] for r in old], docs.collect(), 2048)) <= 2048
            continue
        new = {r.doc_id: tuple(r) for r in docs.collect()}
        assert docs.columns == before.columns
        if name == "toxicity":
            assert set(new.values()) < set(old) and len(new) > 0.8 * len(old)
        elif name == "line_dedup":
            assert {i: r[1] for i, r in new.items()} == {i: t for i, _, _, t in kept_lines([r[:3] for r in old])}
            assert all(r[4] == len(r[1]) for r in new.values())
        elif name == "near_duplicates":
            prints = {r[0]: brute_print(r[1]) for r in old}
            roots = brute_components(prints.values())
            least = {}
            for i in sorted(prints):
                least.setdefault(roots[prints[i]], i)
            assert set(new) == set(least.values())
        else:
            clean = {r[0] for r in old for n, hit, _ in [judged(r[1], bench)] if not (hit and 20 * hit >= n)}
            assert set(new) == clean


def test_pipeline_runs_on_odd_tables(spark, messy, none, tmp_path):
    for name, docs in (("messy", messy), ("none", none)):
        docs = docs.select("doc_id", "text", "lang", "source", "n_chars")
        folder = str(tmp_path / name)
        docs.write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([(1, "beta gamma"), (2, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
        spark.createDataFrame([(1, 1, 1), (None, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
        assert (corpus_pipeline.run(spark, folder).count() > 0) == (name == "messy")


def test_what_a_worker_keeps_goes_when_another_operator_starts():
    from minekit.llm import common

    kept = common.in_worker("words", lambda: ["a"])
    common.drop_held(kept)
    assert common.in_worker("words", lambda: ["b"]) is kept
    common.drop_held()
    assert common.in_worker("words", lambda: ["b"]) == ["b"]
    common.drop_held()
