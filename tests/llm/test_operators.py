"""Each operator against brute force on a small table of hard cases, and on no rows at all."""

import collections
import hashlib
import json
import random
import re
import subprocess
import sys
import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

from tessera.llm import chat, exact_dedup, language, lz, mixing, near, packing, pii, simhash, substrings, token_files, tokens
from tessera.llm.components import components

from .helpers import frame, rows_of, split, table, words

WORD_BPE, BYTE_BPE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")


def sha(x: str) -> str:
    return hashlib.sha256(x.encode()).hexdigest()


@pytest.fixture(scope="module")
def rows():
    return table()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return frame(spark, rows).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return frame(spark, table()[:1]).where("false")


def library(path: str) -> Tokenizer:
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return t


HARD = ["", " ", "a", " a  b", "a\nb", "a \nb", "tab\tx", "it's don't we'll", "x\x1cy z", "<|endoftext|> end", "É é ß", "日本語 テスト", "a b c", "1234 5,6", "end ", "\n", "\r\n x", "A" * 200 + " b", "\0 x"]


@pytest.mark.parametrize("path", [WORD_BPE, BYTE_BPE])
def test_cached_encoding_is_the_library_s(path):
    r = random.Random(3)
    texts = [*HARD, *(words(r, 50) for _ in range(20)), *("".join(r.choice("ab' \n.1É ́") for _ in range(40)) for _ in range(300))]
    t = library(path)
    for _ in range(2):
        got = list(tokens.encode_all(path, texts, 1, most=500))
        assert [np.frombuffer(g, "<u4").tolist() for g in got] == [t.encode(x, add_special_tokens=False).ids + [1] for x in texts]


@pytest.mark.parametrize("path", [WORD_BPE, BYTE_BPE])
def test_every_latin_letter_is_encoded_as_by_the_library(path):
    t, letters = library(path), [chr(c) for c in range(0x250) if chr(c).isalpha()]
    texts = [w for c in letters for w in (c, f"{c}stanbul", f"a{c}b.", f"ab {c}c", f"{c}{c}")]
    assert [list(memoryview(x).cast("I")) for x in tokens.Encoder(path).encode(texts)] == [t.encode(x, add_special_tokens=False).ids for x in texts]


def test_lz_fingerprints(docs, rows, empty):
    got = rows_of(lz.neighbour_likeness(docs, parts=5))
    order = sorted(rows, key=lambda r: (r[0], r[1] or ""), reverse=True)
    assert len(got) == len(rows)
    by = collections.defaultdict(list)
    for g in got:
        by[g["doc_id"]].append(g)
    same = {}
    for k, r in enumerate(order):
        t, following = r[1] or "", order[(k + 1) % len(order)][1] or ""
        n = len(t) // 2
        edited = t[: len(t) - n] + following[:n]
        own, other, after = lz.fingerprint(t), lz.fingerprint(edited), lz.fingerprint(following)
        want = (len(t), sha(edited), own.astype(">u2").tobytes().hex(), other.astype(">u2").tobytes().hex(), round(lz.likeness(own, other), 6), round(lz.likeness(own, after), 6))
        assert want in [tuple(list(g.values())[1:]) for g in by[r[0]]]
        same.setdefault(t, set()).update(g["fingerprint"] for g in by[r[0]])
    assert all(len(x) == 1 for x in same.values())
    assert rows_of(lz.neighbour_likeness(empty)) == []
    assert rows_of(lz.lz_fingerprints(empty)) == []
    a, b = set("abcdefgh"), set()
    lz.parse(b, "", "aabababbbab")
    assert b == {"a", "ab", "aba", "b", "bb"} and a
    # the estimate is near the exact likeness of the phrase sets
    r, err = random.Random(5), []
    for _ in range(30):
        x, y = words(r, 400), words(r, 400)
        y = x[: len(x) // 2] + y[len(x) // 2 :]
        p, q = set(), set()
        lz.parse(p, "", x)
        lz.parse(q, "", y)
        err.append(abs(len(p & q) / len(p | q) - lz.likeness(lz.signature(p), lz.signature(q))))
    assert np.mean(err) < 0.06


@pytest.mark.parametrize("path", [WORD_BPE, BYTE_BPE])
def test_a_full_cache_keeps_what_is_met_most(path, monkeypatch):
    r = random.Random(5)
    monkeypatch.setattr(tokens, "CACHE", 200)
    t, of, asked = library(path), tokens.Encoder(path), collections.Counter()
    word = of.word
    monkeypatch.setattr(of, "word", lambda x: asked.update([x]) or word(x))
    often = ["alpha", "beta", "gamma", "delta"]
    for _ in range(30):  # each call brings 60 words that no other has, so the cache overflows again and again
        texts = [" ".join([*often, *("".join(r.choice("abcdefghij") for _ in range(12)) for _ in range(30)), end]) for end in ("x", "a?!$ Alpha BETA, ÉTÉ'")]
        texts.append("z" * 70 + " 1'a(b)c.. <|endoftext|> " + "é" * 70 + "%")
        assert [np.frombuffer(g, "<u4").tolist() for g in of.encode(texts)] == [t.encode(x, add_special_tokens=False).ids for x in texts]
    # The first word of a text has no blank before it, and the layout that keeps blanks and case has a form for each.
    assert all(n == 1 for x, n in asked.items() if x.strip().lower() in often)
    assert len(of.known) <= 200 and not any(len(x) > tokens.LONGEST_PIECE for x in of.known)


def test_lz_with_null_ids_and_one_row(spark, rows):
    one = frame(spark, [(None, "ab ab", *rows[0][2:])])
    (got,) = rows_of(lz.neighbour_likeness(one))
    assert (got["doc_id"], got["n_chars"], got["edited_sha256"]) == (None, 5, sha("ab aab"[:3] + "ab"))


def test_token_files(spark, docs, rows, empty, tmp_path):
    t = library(WORD_BPE)
    want = collections.Counter()
    at = 0
    for r in sorted(rows, key=lambda r: r[0]):
        ids = np.array(t.encode(r[1] or "", add_special_tokens=False).ids + [1], "<u4")
        want[r[0], at, len(ids), zlib.crc32(ids.tobytes())] += 1
        at += len(ids)
    old = token_files.FILE_DOCS, token_files.SEGMENT
    token_files.FILE_DOCS, token_files.SEGMENT = 10, 300
    try:
        got = rows_of(token_files.round_trip(docs, WORD_BPE))
    finally:
        token_files.FILE_DOCS, token_files.SEGMENT = old
    assert collections.Counter(tuple(g.values()) for g in got) == want
    assert rows_of(token_files.round_trip(empty, WORD_BPE)) == []
    path = str(tmp_path / "ids")
    token_files.write(docs, WORD_BPE, path)
    r = rows[30]
    other = spark.newSession()  # nothing but the path tells it how to read
    want_ids = t.encode(r[1] or "", add_special_tokens=False).ids + [1]
    assert token_files.open_document(other, path, r[0]).tolist() == want_ids
    script = f"from pyspark.sql import SparkSession\nfrom tessera.llm import token_files\ns = SparkSession.builder.master('local[1]').getOrCreate()\nprint('ids', token_files.open_document(s, {path!r}, {r[0]}).tolist())"
    done = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, check=True, timeout=120)
    assert f"ids {want_ids}" in done.stdout
    with pytest.raises(KeyError):
        token_files.open_document(spark, path, 2)
    dictionary = token_files.dictionary_of(spark, path)
    body = spark.read.parquet(f"{path}/ids").first().body
    with pytest.raises(ValueError, match="dictionary"):
        token_files.Segment(body, dictionary + b"x")


def test_tokenizers_of_other_parts_get_whole_texts(tmp_path):
    made = json.loads(open(BYTE_BPE, encoding="utf-8").read())
    assert tokens.layout(made) == "keeps" and tokens.layout(json.loads(open(WORD_BPE, encoding="utf-8").read())) == "drops"
    made["normalizer"] = {"type": "Replace", "pattern": {"String": " "}, "content": "_"}
    path = str(tmp_path / "other.json")
    with open(path, "w", encoding="utf-8") as f:
        json.dump(made, f)
    assert tokens.layout(made) is None
    texts = ["a b c", "some words here", "x  y"]
    t = library(path)
    assert [np.frombuffer(g, "<u4").tolist() for g in tokens.encode_all(path, texts, 0)] == [t.encode(x, add_special_tokens=False).ids + [0] for x in texts]


def test_language_id(spark, empty):
    r = random.Random(7)
    pools = {"aa": ["the", "and", "thing", "with"], "bb": ["der", "und", "schön", "nicht"], "cc": ["le", "très", "où", "été"]}
    for pool in pools.values():  # words of the language's own parts, so that texts have many n-grams
        pool += ["".join(r.choice(pool[:4]) for _ in range(2)) for _ in range(12)] + ["".join(r.choices(pool[r.randrange(4)], k=7)) for _ in range(40)]
    rows = [(k, " ".join(r.choice(pools[x]) for _ in range(60)) + ("" if k % 7 else " 123 $$$"), x, "s", 1, True, "", 1, 1, 1, 1, "") for k, x in enumerate(r.choice(list(pools)) for _ in range(300))]
    rows += [(1000, None, "aa", *rows[0][3:]), (1001, "12 $$ 3", "aa", *rows[0][3:]), (1002, "", None, *rows[0][3:]), (1003, "und nicht der", None, *rows[0][3:]), (1004, "".join(map(chr, range(0x4E00, 0x4F00))), None, *rows[0][3:])]
    got = {g["doc_id"]: g for g in rows_of(language.language_id(frame(spark, [*rows, rows[0]])))}
    assert all(g["held_out"] == (zlib.crc32(str(k).encode()) % 3 == 1) for k, g in got.items())
    assert np.mean([got[x[0]]["lang_pred"] == x[2] for x in rows[:300]]) > 0.99
    assert not any(got[x[0]]["rejected"] for x in rows[:300])
    for k in (1000, 1001, 1002):
        assert (got[k]["lang_pred"], got[k]["score"], got[k]["rejected"]) == ("und", 0.0, True)
    assert got[1003]["lang_pred"] == "bb" and got[1004]["rejected"] and not got[1003]["rejected"]
    assert rows_of(language.language_id(empty)) == [] and rows_of(language.accepted(empty)) == []
    assert {g["lang_pred"] for g in rows_of(language.language_id(frame(spark, [(1, "a b", None, *rows[0][3:])])))} == {"und"}
    kept = rows_of(language.accepted(frame(spark, rows)))
    assert len(kept) == 301 and list(kept[0]) == list(rows_of(frame(spark, rows[:1]))[0])


def brute_substrings(rows, window):
    where = collections.Counter(tuple(w[i : i + window]) for w in (split(r[1]) for r in rows) for i in range(len(w) - window + 1))
    for r in rows:
        w = split(r[1])
        gone = {j for i in range(len(w) - window + 1) if where[tuple(w[i : i + window])] > 1 for j in range(i, i + window)}
        yield r[0], len(w), len(gone), sha(" ".join(x for j, x in enumerate(w) if j not in gone))


@pytest.mark.parametrize(("window", "gram", "width", "bits", "piece"), [(35, 8, None, 1 << 28, None), (5, 2, 64, 64, 50), (3, 3, None, 1 << 12, 200)])
def test_substring_dedup(docs, rows, empty, window, gram, width, bits, piece):
    """Also with a full sketch and filter, several passes, and texts in pieces."""
    old, substrings._BYTES = substrings._BYTES, piece or substrings._BYTES
    try:
        if piece:  # functions that go to the workers carry the module's values only where they are their own
            for t in ("", "a", " a  b\n", words(random.Random(1), 90), "x" * 300 + " y"):
                parts = list(substrings.pieces(t.encode(), window, piece))
                got = [(before + k, w[k : k + window]) for before, part in parts for w in [part.split()] for k in range(len(w) - window + 1)]
                w = t.encode().split()
                assert got == [(k, w[k : k + window]) for k in range(len(w) - window + 1)]
        got = rows_of(substrings.substring_dedup(docs, window, gram, width, bits))
    finally:
        substrings._BYTES = old
    assert sorted(tuple(g.values()) for g in got) == sorted(brute_substrings(rows, window))
    if window == 35:
        assert any(g["n_removed"] for g in got)
        assert rows_of(substrings.substring_dedup(empty)) == []
        assert all(sha(g["kept"]) == g["kept_sha256"] for g in rows_of(substrings.substring_dedup(docs, texts=True)))


def test_the_sketch_overestimates_and_prefilters(docs, rows):
    """All counters of repeated anchors are two or more in the merged sketch; of the others hardly any."""
    width = substrings.width_for(sum(len((r[1] or "").encode()) for r in rows))
    over = {c["cell"] for c in rows_of(substrings.repeated_cells(docs.repartition(5), 35, 8, width))}
    counts, place = collections.Counter(), set()
    for k, r in enumerate(rows):
        _, anchor, at = substrings.anchors(substrings.Words([(r[1] or "").encode()]), 35, 8)
        for x, y in zip(anchor.tolist(), at.tolist(), strict=True):
            if (k, y) not in place:
                place.add((k, y))
                counts[x] += 1
    of = lambda x: [int(c[0]) for c in substrings.cells(np.array([x], np.uint64), width)]
    assert all(set(of(x)) <= over for x, n in counts.items() if n > 1) and any(n > 1 for n in counts.values())
    alone = [x for x, n in counts.items() if n == 1]
    assert sum(set(of(x)) <= over for x in alone) <= 0.01 * len(alone) + 1


BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def brute_spans(text):
    def fits(kind, m):
        digits = [int(c) for c in m if c.isdigit()]
        if kind == "ip":
            return all(int(x) <= 255 for x in m.split("."))
        if kind == "card":
            return 12 <= len(digits) <= 19 and sum(sum(divmod(2 * d, 10)) if k % 2 else d for k, d in enumerate(digits[::-1])) % 10 == 0
        return kind == "email" or 9 <= len(digits) <= 15

    return sorted(((m.start(), m.end(), k) for k, x in BASE.items() for m in re.finditer(x, text) if fits(k, m[0])), key=lambda s: (s[0], list(BASE).index(s[2])))


def test_pii_base_spans():
    r = random.Random(11)
    parts = ["a.b@c.de", "@x.y", "x@y", "1.2.3.4", "300.1.1.1", "1.2.3.4.5", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (988) 555-2485", "+12", "1234567890123456789012", "é", " ", "@", ".", "-", "+", "5", "0000000001.02.3.4", "a_%+-@b-c.d.e", "\n"]
    for _ in range(3000):
        text = "".join(r.choice(parts) for _ in range(r.randint(1, 9)))
        assert pii.base_spans(text) == brute_spans(text), text
        assert [x[:3] for x in pii.find(text) if x[2] in pii.BASE_KINDS] == brute_spans(text)


def test_pii(spark, empty, rows):
    text = "Konto IBAN DE89 3704 0044 0532 0130 00 bitte, IBAN DE89 3704 0044 0532 0130 01; card 4111.1111.1111.1111 é a@b.cd"
    got = rows_of(pii.digest(pii.pii(frame(spark, [(1, text, *rows[0][2:]), (2, None, *rows[0][2:]), (2, "", *rows[0][2:])]))))
    first = next(g for g in got if g["doc_id"] == 1)
    assert [x.split(":")[0] for x in first["spans"].split(",")] == ["iban", "card_near", "email"]
    assert first["n_email"] == 1 and first["base_sha256"] == sha(f"email:{text.index('a@b')}:{len(text)}")
    assert [g["spans"] for g in got if g["doc_id"] == 2] == ["", ""] and got[-1]["base_sha256"]
    assert rows_of(pii.digest(pii.pii(empty))) == []
    assert pii.masked("an a@b.cd!") == "an [EMAIL]!"
    assert len(pii.base_spans("1" * 200_000 + "." * 200_000 + "a" * 200_000)) == 0


def brute_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: 1 + k % 3 for k, s in enumerate(names)}
    target, free, left = {}, set(names), float(sum(sizes.values()))
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 3 * sizes[s]}
        if not over:
            return target | share
        target |= {s: 3.0 * sizes[s] for s in over}
        left -= sum(3 * sizes[s] for s in over)
        free -= over


def test_mixing(spark, docs, rows, empty):
    got = rows_of(mixing.mix_sources(docs))
    assert collections.Counter((g["doc_id"], g["size"]) for g in got) == collections.Counter((r[0], len(split(r[1]))) for r in rows)
    source = {r[0]: r[3] for r in rows}
    sizes = collections.Counter()
    for r in rows:
        sizes[r[3]] += len(split(r[1]))
    target = brute_targets(sizes)
    taken = collections.Counter()
    for g in got:
        s = source[g["doc_id"]]
        assert g["source_size"] == sizes[s] and g["target"] == pytest.approx(target[s])
        assert g["taken"] in {k * g["size"] for k in range(4)}
        taken[s] += g["taken"]
    assert sum(taken.values()) <= sum(sizes.values())
    biggest = max(len(split(r[1])) for r in rows)
    assert all(abs(taken[s] - target[s]) <= 2 * biggest for s in sizes)
    again = rows_of(mixing.mix_sources(docs.repartition(7)))
    assert sorted(map(str, again)) == sorted(map(str, got))
    out = rows_of(mixing.mixed(docs))
    assert sum(len(split(x["text"])) for x in out) == sum(taken.values()) and list(out[0]) == docs.columns
    assert rows_of(mixing.mix_sources(empty)) == [] and rows_of(mixing.mixed(empty)) == []
    assert {g["taken"] for g in rows_of(mixing.mix_sources(frame(spark, [(1, None, *rows[0][2:]), (2, " ", *rows[0][2:])])))} == {0}


def check_packing(got, texts, end=0, capacity=2048):
    t = library(BYTE_BPE)
    want = collections.Counter()
    for i, x in texts:
        ids = np.array(t.encode(x or "", add_special_tokens=False).ids + [end], "<u4")
        first = len(ids) % capacity or capacity
        cuts = [0, *range(first, len(ids), capacity), len(ids)]
        for k, (s, e) in enumerate(zip(cuts, cuts[1:], strict=False)):
            want[i, k, s, e - s, zlib.crc32(ids[s:e].tobytes())] += 1
    assert collections.Counter((g["doc_id"], g["piece"], g["start"], g["length"], g["ids_crc32"]) for g in got) == want
    bins = collections.defaultdict(list)
    for g in got:
        bins[g["sequence_id"]].append((g["offset"], g["length"]))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins), sum(g["length"] for g in got)


@pytest.mark.parametrize("node", [1 << 15, 40, 9])
def test_packing(docs, rows, empty, node):
    got = rows_of(packing.pack(docs, BYTE_BPE, node=node))
    bins, total = check_packing(got, [(r[0], r[1]) for r in rows])
    assert bins <= -(-total // 2048) + (1 if node > 40 else 6)
    assert rows_of(packing.pack(empty, BYTE_BPE)) == []


def test_best_fit_against_a_plain_scan():
    r = random.Random(2)
    for _ in range(50):
        sizes = np.array([r.randint(1, 20) for _ in range(60)])
        _, _, fill = packing.best_fit(sizes, 20)
        bins = []
        for s in sorted(sizes.tolist(), reverse=True):
            fits = [b for b in range(len(bins)) if bins[b] + s <= 20]
            b = max(fits, key=lambda b: bins[b]) if fits else len(bins)
            bins[b:] = [*(bins[b : b + 1] or [0]), *bins[b + 1 :]]
            bins[b] += s
        assert sorted(fill.tolist()) == sorted(bins)


def brute_dedup(rows):
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    groups = collections.defaultdict(list)
    for r in rows:
        groups[norm(r[1])].append(r[0])
    return {(r[0], min(groups[norm(r[1])]), len(groups[norm(r[1])]), sha(norm(r[1]))) for r in rows}, len(groups)


@pytest.mark.parametrize(("capacity", "bits"), [(8192, 1 << 20), (2, 64)])
def test_exact_dedup(docs, rows, empty, capacity, bits):
    got = rows_of(exact_dedup.exact_dedup(docs, capacity=capacity, bloom_bits=bits))
    want, groups = brute_dedup(rows)
    assert len(got) == len(rows)
    assert {(g["doc_id"], g["keep_id"], g["group_size"], g["text_sha256"]) for g in got} == want
    assert sum(g["kept"] for g in got) == groups and all(g["doc_id"] == g["keep_id"] for g in got if g["kept"])
    if capacity > 2:
        assert rows_of(exact_dedup.exact_dedup(empty)) == [] and rows_of(exact_dedup.keep_first(empty)) == []
        kept = rows_of(exact_dedup.keep_first(docs))
        assert len(kept) == groups and list(kept[0]) == docs.columns


def test_directory_doubling():
    r = random.Random(9)
    keys = np.sort(np.array([r.getrandbits(64) for _ in range(300)] + [r.getrandbits(40) for _ in range(100)] + [5 << 60] * 60, np.uint64))
    got = exact_dedup.double(keys, 25)
    assert [x for _, s, e in got for x in range(s, e)] == list(range(len(keys)))
    for d, s, e in got:
        some = set(keys[s:e].tolist())
        assert len({x >> (64 - d) for x in some}) <= 1 or d == 0
        assert e - s <= 25 or len(some) == 1
        up = [x for x in keys.tolist() if s < e and x >> (65 - d) == int(keys[s]) >> (65 - d)] if d else []
        assert not d or s == e or len(up) > 25  # no bucket was split in vain
    assert exact_dedup.double(keys[:0], 25) == [(0, 0, 0)]


def test_the_index_takes_a_second_batch(spark):
    r = random.Random(12)
    rows = [(long_of(r.getrandbits(64) if k % 3 else k % 5), bytes([k % 7]) * 32, k if k % 11 else None) for k in range(400)]
    first, second = (spark.createDataFrame(x, "key long, sha binary, id long") for x in (rows[:150], rows[150:]))
    one = exact_dedup.add(None, first, 8, 2)
    two = exact_dedup.add(one, second, 8, 2)
    assert one.count() < two.count()  # full buckets split
    want = collections.defaultdict(list)
    for k, s, i in rows:
        want[k, s].append(i)
    got = {(e["key"], bytes(e["sha"])): (e["id"], e["n"]) for e in rows_of(exact_dedup.entries_of(two))}
    assert got == {x: (min((i for i in ids if i is not None), default=None), len(ids)) for x, ids in want.items()}
    for bucket in rows_of(two):
        keys = {k % (1 << 64) for k in exact_dedup.unpack_bucket(bytes(bucket["body"]))["key"].to_pylist()}
        assert {k >> (64 - bucket["depth"]) for k in keys} == {bucket["prefix"]} and (bucket["entries"] <= 8 or len(keys) == 1)
        assert {k >> 62 for k in keys} == {bucket["owner"]}


def test_owners_chain_colliding_keys_and_compare_bytes():
    import pyarrow as pa

    digest = lambda x: hashlib.sha256(x.encode()).digest()
    rows = [(7, digest("a"), 1, 3, None), (7, digest("b"), 2, 1, None), (7, None, None, 1, "a"), (7, None, None, 1, "b"), (7, None, None, 2, "a"), (8, digest("c"), 9, 1, None), (8, None, None, 1, "c")]
    batch = lambda x: pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*x), (pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.string()), strict=True)], names=["key", "sha", "id", "n", "text"])
    got = [r for x in exact_dedup.compare([batch(rows[:3]), batch(rows[3:])]) for r in x.to_pylist()]
    assert [(r["key"], r["keep_id"], r["group_size"]) for r in got] == [(7, 1, 3), (7, 2, 1), (8, 9, 1)]
    for wrong in (rows[:4], [*rows[:2], (7, None, None, 1, "z")]):  # an entry lacks rows; a text has no entry
        with pytest.raises(ValueError, match="does not hold"):
            list(exact_dedup.compare([batch(wrong)]))


def brute_fingerprint(text, k=4):
    w = split("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return 0
    hs = [xxhash.xxh64_intdigest(" ".join(w[i : i + k]).encode(), 42) for i in range(max(1, len(w) - k + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(fps, bits=4):
    up = {i: i for i, _ in fps}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for k, (i, a) in enumerate(fps):
        for j, b in fps[:k]:
            if (a ^ b).bit_count() <= bits and root(i) != root(j):
                up[max(root(i), root(j))] = min(root(i), root(j))
    return {i: root(i) for i, _ in fps}


def test_simhash(spark, docs, rows, empty):
    got = rows_of(simhash.simhash_groups(docs))
    fps = {(r[0], brute_fingerprint(r[1])) for r in rows}
    want = brute_components(sorted(fps))
    assert collections.Counter((g["doc_id"], g["fingerprint"], g["component_id"]) for g in got) == collections.Counter((r[0], f"{dict(fps)[r[0]]:016x}", want[r[0]]) for r in rows)
    assert rows_of(simhash.simhash_groups(empty)) == []


def long_of(c):
    return c - (1 << 64) if c >> 63 else c


def codes_with_links(n, r):
    codes = {r.getrandbits(64) for _ in range(n)}
    for c in list(codes)[: n // 2]:
        for _ in range(2):
            for b in r.sample(range(64), r.randint(0, 5)):
                c ^= 1 << b
            codes.add(c)
    return sorted(codes)


@pytest.mark.parametrize(("n", "block"), [(1, 4), (7, 1 << 16), (300, 3), (2000, 1 << 16)])
def test_gray_index_finds_every_link(spark, n, block):
    r = random.Random(n)
    codes = codes_with_links(n, r)
    if n == 300:  # upper nodes that many tasks and blocks hold; the one order that they share leads with bits 51 and up
        far = [r.getrandbits(51) for _ in range(60)]
        codes = sorted({*codes, *(x | 5 << 51 for x in far), *(x ^ (1 << 3 | 1 << 15 | 1 << 28 | 1 << 40) | 5 << 51 for x in far)})
    df = spark.createDataFrame([(long_of(c),) for c in codes], "fp long")
    found = {x["node"]: x["root"] for x in rows_of(components(simhash.near_pairs(df, block=block, task_rows=500)))}
    want = brute_components(list(enumerate(codes)))
    groups = collections.defaultdict(set)
    for k, root in want.items():
        groups[root].add(long_of(codes[k]))
    assert {c: found.get(c, c) for c in map(long_of, codes)} == {c: min(g) for g in groups.values() for c in g}


@pytest.mark.parametrize("groups", [5, 6, 7])
def test_some_order_leads_with_equal_bits(groups, monkeypatch):
    monkeypatch.setattr(simhash, "NODE", {5: 1 << 12, 6: 2, 7: 0}[groups])
    every = simhash.orders(1 << 22, 4)
    assert len(every) == {5: 5, 6: 15, 7: 35}[groups] and all(sum(w for _, w in g) == 64 for g, _ in every)
    r = random.Random(groups)
    for _ in range(300):
        x = sum(1 << b for b in r.sample(range(64), r.randint(0, 4)))
        assert any(x & lead == 0 for _, lead in every)
    codes = np.array([r.getrandbits(64) for _ in range(50)], np.uint64)
    for g, lead in every:
        turned = simhash.in_order(codes, g)
        assert [x.bit_count() for x in turned.tolist()] == [x.bit_count() for x in codes.tolist()]
        assert [x >> (64 - lead.bit_count()) == 0 for x in turned.tolist()] == [x & lead == 0 for x in codes.tolist()]


@pytest.mark.parametrize("split", [0, 130])
def test_a_forest_has_the_components_of_all_links(split):
    r = random.Random(split)
    codes = codes_with_links(120, r) + [0x1234 ^ (1 << k) ^ (1 << j) for k in range(30) for j in range(k)]
    codes = sorted(set(codes), key=lambda c: int(simhash.gray_rank(np.array([c], np.uint64))[0]))
    a, b = np.array(codes[:split] or codes, np.uint64), np.array(codes[split:], np.uint64)
    got = [tuple(x) for x in simhash.forest_of(a, b if split else None, 0, 4).tolist()]
    pairs = [(x, y) for k, x in enumerate(codes) for j, y in enumerate(codes[:k]) if (x ^ y).bit_count() <= 4 and (not split or j < split <= k)]
    up = {c: c for c in codes}

    def root(c):
        while up[c] != c:
            c = up[c]
        return c

    for links in (got, pairs):
        for x, y in links:
            up[max(root(x), root(y))] = min(root(x), root(y))
        if links is got:
            joined = {c: root(c) for c in codes}
    assert joined == {c: root(c) for c in codes} and set(map(frozenset, got)) <= set(map(frozenset, pairs)) and len(got) < len(codes)


def test_gray_rank():
    codes = np.array([k ^ (k >> 1) for k in range(64)], np.uint64)
    assert simhash.gray_rank(codes).tolist() == list(range(64))


def test_components_of_long_chains(spark):
    r = random.Random(4)
    order = list(range(200))
    r.shuffle(order)
    edges = [*zip(order, order[1:], strict=False), (500, 501), (501, 500), (7, 7)]
    got = {x["node"]: x["root"] for x in rows_of(components(spark.createDataFrame(edges, "u long, v long")))}
    assert got == {k: 0 for k in range(1, 200)} | {501: 500}


def test_chat(spark):
    r = random.Random(6)
    texts = ["", None, "a<b>c", "\\", "\\<", "</turn>\n<turn user>\n", chat.PROBE, "é\n\n", "x" * 5000]
    rows = [(c, t, r.choice(["user", "assistant", "system", None, "a\nb<"]), r.choice(texts)) for c in range(40) for t in range(r.randint(1, 12))]
    rows.append((99, 5, "assistant", "only"))
    df = spark.createDataFrame([(*x, "x") for x in rows], "conv_id long, turn long, role string, text string, id string").repartition(3)
    got = {g["conv_id"]: g for g in rows_of(chat.read_back(chat.format_trees(chat.chains(chat.with_probe(df)))))}
    every = collections.defaultdict(list)
    for c, _, role, t in sorted(rows, key=lambda x: x[:2]):
        every[c].append((role or "", t or ""))
    every[-7] = [("user", chat.PROBE), ("assistant", chat.PROBE)]
    assert set(got) == set(every)
    for c, turns in every.items():
        loss = "".join(t for role, t in turns if role == "assistant")
        g = got[c]
        assert (g["n_turns"], g["turns_sha256"]) == (len(turns), sha("".join(f"{a}\n{b}\n" for a, b in turns)))
        assert (g["loss_chars"], g["loss_sha256"]) == (len(loss), sha(loss))
        assert g["formatted_chars"] == len(chat.format_turns(turns)[0]) and chat.parse_turns(chat.format_turns(turns)[0]) == turns
    assert rows_of(chat.read_back(chat.format_trees(chat.chains(df.where("false"))))) == []


def test_reply_trees_choose_the_best_path(spark):
    #       1 - 2 - 4 (good)      10 -> 11 -> 10 is a cycle, 20 has an unknown parent
    #         \ 3 - 5 - 6 (bad)
    m = [(1, None, 1.0), (2, 1, 2.0), (3, 1, 0.0), (4, 2, 5.0), (5, 3, 1.0), (6, 5, 1.0), (10, 11, 1.0), (11, 10, 1.0), (20, 77, None), (21, 20, 1.0), (22, 20, 1.0)]
    got = rows_of(chat.paths(spark.createDataFrame(m, "id long, parent long, score double")))
    assert sorted((g["root"], g["depth"], g["id"]) for g in got) == [(1, 0, 1), (1, 1, 2), (1, 2, 4), (20, 0, 20), (20, 1, 21)]




def near_sets(rows):
    for r in rows:
        w = split("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r[1] or ""))
        yield r, {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}


def brute_near(rows):
    """The roots by all pairs of sets with a Jaccard likeness of 0.8 or more, or fingerprints within four bits, by place in rows."""
    sets, fps = [s for _, s in near_sets(rows)], [brute_fingerprint(r[1]) for r in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if (5 * len(a & sets[j]) >= 4 * len(a | sets[j]) or (fps[i] ^ fps[j]).bit_count() <= 4) and root(i) != root(j):
                up[max(root(i), root(j))] = min(root(i), root(j))
    return [root(i) for i in range(len(rows))]


def near_rows(rows):
    """Copies with more and more words changed (likeness from 1 to under 0.8), chains of them, and a passage that many texts share."""
    r = random.Random(21)
    texts = []
    for _ in range(6):
        w = words(r, 200).split()
        for n in (0, 1, 2, 3, 4, 5, 6):
            texts.append(" ".join(f"q{n}" if k % 40 == 20 and k // 40 < n else x for k, x in enumerate(w)))
        for k in range(12):  # each replaces one more stretch of the last one: its ends are linked only by way of others
            w = [*w[: 10 * k], *words(r, 6).split(), *w[10 * k + 6 :]]
            texts.append(" ".join(w))
    passage = words(r, 30)
    texts += [f"{passage} {words(r, n)}" for n in (0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 12, 15, 20, 30) for _ in range(4)]
    texts += ["", " ", None, "a b", "A  B", "a b c"]
    return [*rows, *((1000 + k, t, *rows[0][2:]) for k, t in enumerate(texts))]


def test_near_dedup_links_every_pair(spark, rows, empty):
    every = near_rows(rows)
    roots = brute_near(every)
    best = {}
    for k, r in zip(roots, every, strict=True):
        best[k] = min(best.get(k, r[0]), r[0])
    kept = rows_of(near.keep_one(frame(spark, every)))
    assert sorted(x["doc_id"] for x in kept) == sorted(best.values())
    assert len(best) < len(every) - 60 and list(kept[0]) == frame(spark, rows[:1]).columns
    assert rows_of(near.keep_one(empty)) == []
    import corpus_pipeline

    assert len(rows_of(corpus_pipeline.drop_near_copies(spark, frame(spark, every), ""))) == len(best)


def test_the_rows_decided_on_stay(spark, rows):
    """Texts that share an id, or have none: the copies go, the others stay."""
    r = random.Random(8)
    a, b, c, d = (words(r, 40) for _ in range(4))
    some = [(i, t, *rows[0][2:]) for i, t in [(3, a), (None, a), (None, b), (None, c), (None, c), (7, d), (7, b), (8, d), (8, f"{c} x")]]
    kept = lambda f, x: sorted((x["doc_id"] or 0, x["text"]) for x in rows_of(f(frame(spark, x))))
    assert kept(exact_dedup.keep_first, some) == sorted([(3, a), (7, b), (0, c), (7, d), (8, f"{c} x")])
    assert kept(near.keep_one, some) == sorted([(3, a), (7, b), (7, d), (8, f"{c} x")])
    for seed in (1,):  # the text of the copy comes before or after the others in order
        x, y = sorted([words(random.Random(seed), 30), words(random.Random(seed + 50), 30)])
        for copy, own in ((x, y), (y, x)):
            for i in (None, 5):
                rows_ = [(3, copy, *rows[0][2:]), (i, copy, *rows[0][2:]), (i, own, *rows[0][2:])]
                assert kept(exact_dedup.keep_first, rows_) == kept(near.keep_one, rows_) == sorted([(3, copy), (i or 0, own)])


def test_simhash_links_by_way_of_rows_without_an_id(spark, rows):
    """A chain a - b - c of which only the neighbours are within four bits; b has no id."""
    r = random.Random(3)
    while True:
        a = words(r, 300)
        steps = [a]
        for k in (1, 2):
            w = steps[-1].split()
            w[100 * k] = f"qq{k}"
            steps.append(" ".join(w))
        x, y, z = (brute_fingerprint(t) for t in steps)
        if (x ^ y).bit_count() <= 4 and (y ^ z).bit_count() <= 4 < (x ^ z).bit_count():
            break
    other = words(r, 50)
    some = [(i, t, *rows[0][2:]) for i, t in [(5, steps[0]), (None, steps[1]), (9, steps[2]), (None, other), (None, other), (5, words(r, 60))]]
    got = rows_of(simhash.simhash_groups(frame(spark, some)))
    want = {f"{x:016x}": 5, f"{y:016x}": 5, f"{z:016x}": 5, f"{brute_fingerprint(other):016x}": None, f"{brute_fingerprint(some[5][1]):016x}": 5}
    assert len(got) == 6 and all(g["component_id"] == want[g["fingerprint"]] for g in got)
    kept = rows_of(near.keep_one(frame(spark, some)))
    assert sorted((k["doc_id"] or 0, k["text"]) for k in kept) == sorted([(5, steps[0]), (0, other), (5, some[5][1])])
