"""The dealt methods themselves, against plain versions, and cases that once went wrong."""

import gzip
import io
import itertools
import math

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from fixtrail.llm import chunk_dedup, html_trees, jaccard_join, lattice_lm, packing, string_kernel, warc, words
from fixtrail.llm.words import WordHashes
from tests.llm.test_corpus import EDGE, docs_of, prose


def test_gear_hash_remembers_sixteen_bytes():
    rng = np.random.default_rng(1)
    words = [bytes(rng.integers(97, 123, rng.integers(1, 12)).astype(np.uint8)) for _ in range(80)]
    text, value, at, wanted = b" " + b" ".join(words), 0, 0, []
    ends = {e for e in np.cumsum([len(w) + 1 for w in words]) - 1}
    for at, byte in enumerate(text):
        value = (value << 1) + int(chunk_dedup._GEAR[byte]) & 0xFFFF
        if at in ends:
            wanted.append(value)
    assert chunk_dedup.gear(words).tolist() == wanted
    for k in range(0, 60):
        assert chunk_dedup.gear(words[k:])[8:].tolist() == wanted[k + 8 :]


def test_boundaries_are_least_of_some_run():
    rng = np.random.default_rng(2)
    for n in (0, 3, 5, 40, 300):
        value = rng.integers(0, 12, n).astype(np.uint16)
        wanted = {min(range(k, k + 5), key=lambda i: (value[i], i)) for k in range(n - 4)}
        assert chunk_dedup.boundaries(value, 5).tolist() == sorted(wanted)


@pytest.mark.parametrize("letters", [1, 2, 9])
def test_equal_windows_have_equal_anchors(letters):
    rng = np.random.default_rng(letters)
    word = lambda: bytes(rng.integers(97, 100, rng.integers(1, letters + 1)).astype(np.uint8))
    for _ in range(60):
        passage = [word() for _ in range(51)]
        digests = []
        for _ in range(2):
            before = [word() for _ in range(rng.integers(0, 70))]
            raw = b" ".join([*before, *passage, *(word() for _ in range(rng.integers(0, 70)))])
            start, digest, anchor = chunk_dedup.Passages(raw, WordHashes()).chunks()
            digests.append(digest[anchor[len(before)]])
            ends = np.append(start[1:], 0)
            own = anchor[len(before)]
            assert own == len(start) - 1 or ends[own] - start[own] <= chunk_dedup.reach(51)
        assert digests[0] == digests[1]


def test_insertion_moves_chunks_along():
    words = prose(5, 400).encode().split()
    digest = lambda w: set(chunk_dedup.Passages(b" ".join(w), WordHashes()).chunks()[1].tolist())
    changed = digest(words) ^ digest([*words[:150], b"new", b"words", *words[150:]])
    assert len(changed) <= 12


def test_scores_do_not_depend_on_how_files_are_cut(spark, tmp_path):
    docs = docs_of(spark, [*EDGE, *[prose(k, 300) for k in range(200)]]).select("doc_id", "text")
    path = str(tmp_path / "d")
    docs.repartition(3).write.parquet(path)
    read = lambda: spark.read.parquet(path)
    one = lattice_lm.score_documents(read())
    before = spark.conf.get("spark.sql.files.minPartitionNum", None)
    try:
        spark.conf.set("spark.sql.files.minPartitionNum", "23")
        first = sorted(map(tuple, one.collect()))
        spark.conf.set("spark.sql.files.minPartitionNum", "2")
        second = sorted(map(tuple, one.collect()))
        other = sorted(map(tuple, lattice_lm.score_documents(read()).collect()))
    finally:
        if before is None:
            spark.conf.unset("spark.sql.files.minPartitionNum")
        else:
            spark.conf.set("spark.sql.files.minPartitionNum", before)
    assert first == second and len(first) == 208
    for a, b in zip(first, other, strict=True):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], rel=1e-12) and a[6] == pytest.approx(b[6], rel=1e-9)


def test_scores_of_an_empty_table(spark):
    assert lattice_lm.score_documents(docs_of(spark, ["x"]).limit(0)).collect() == []


_ARTICLE = (
    "<article><h1>A title of it</h1><p>A good long paragraph of text, with commas and a stop. It goes on for a while, and then "
    "some more.</p><p>Another one that goes on for long enough to count as text. It has two sentences.</p></article>"
)


def _text(page, model):
    nodes = html_trees.parse(page)
    labels = html_trees.decode(nodes, model.logit(html_trees.features(nodes)))
    return "\n\n".join(n.text for n, kept in zip(nodes, labels, strict=True) if kept and n.text)


_BEFORE = {
    "head not closed": "<html><head><title>T</title><meta charset=utf-8>",
    "text in head": "<html><head><title>T</title>",
    "button": "<html><body><div><button>Menu",
    "button in a block": "<html><body><div><button><div>Menu</div></div>",
    "select": "<html><body><select><option>a<option>b",
    "nested svg": "<html><body><svg><svg/><path d='x'/></svg>",
    "svg not closed": "<body><div><svg><g></div>",
    "textarea": "<body><textarea>",
    "script in head": "<head><script>var a='<p>text</p>';</script>",
    "template": "<body><div><template><p>x</div>",
}


@pytest.mark.parametrize("case", _BEFORE)
def test_article_survives_unclosed_elements_before_it(case):
    model = html_trees.fit_extractor([])
    runs = lambda page: [n.text for n in html_trees.parse(page) if n.tag == "#run"]
    assert runs(_BEFORE[case] + _ARTICLE + "</body></html>") == runs(f"<html><body>{_ARTICLE}</body></html>")
    assert "Another one" in _text(f"<html><body>{_ARTICLE}</body></html>", model)


def test_elements_that_are_skipped_stay_skipped():
    runs = lambda page: [n.text for n in html_trees.parse(page) if n.tag == "#run"]
    assert runs("<p>a<button><div>x</div>y</button>b</p>") == ["ab"]
    assert runs("<div><select><option>x</select>b</div>") == ["b"]
    assert runs("<head><title>x</title><style>p{}</style></head><body>b") == ["b"]
    assert runs("<svg><title>x</title><text>y</text></svg>b<template><p>z</p></template>") == ["b"]


def test_decoding_is_the_likeliest_consistent_labelling():
    rng = np.random.default_rng(3)
    for _ in range(200):
        n = int(rng.integers(2, 9))
        nodes = [html_trees.Node("#root", -1, 0, 0, 0, 0.0, 0.0, 0, 0)]
        nodes += [html_trees.Node("div", int(rng.integers(0, k)), 1, 0, 0, 0.0, 0.0, 0, 0) for k in range(1, n)]
        logit = rng.normal(size=n) * 2

        def value(labels, logit=logit):
            return sum(-math.log1p(math.exp(-x if kept else x)) for x, kept in zip(logit, labels, strict=True))

        every = [(True, *x) for x in itertools.product([True, False], repeat=n - 1)]
        fit = [x for x in every if all(x[nodes[k].parent] or not x[k] for k in range(1, n))]
        assert value(html_trees.decode(nodes, logit)) == pytest.approx(max(map(value, fit)))


def test_ids_equal_the_tokenizer_on_any_spacing():
    path = public_tokenizers.path("byte_bpe_50k.json")
    plain = Tokenizer.from_file(path)
    plain.encode_special_tokens = True
    encoder = packing.Encoder(path)
    rng = np.random.default_rng(4)
    parts = ["a", "bc", "Z", " ", "  ", "   ", "\n", "\t", "\r\n", "\x1c", "\x85", ".", "!!", ",", "don't", "12", "é", "日本", "<|endoftext|>", "　", "x" * 60]
    texts = ["".join(rng.choice(parts, rng.integers(0, 14))) for _ in range(3000)] + [None, "", " ", "  ", "a ", " a"]
    for k in range(0, len(texts), 250):
        for text, ids in zip(texts[k : k + 250], encoder.batch(texts[k : k + 250]), strict=True):
            assert ids.tolist() == plain.encode(text or "", add_special_tokens=False).ids


def test_words_met_lately_stay_known_when_the_table_is_full(monkeypatch):
    path = public_tokenizers.path("byte_bpe_50k.json")
    assert packing.encoder_of(path) is packing.encoder_of(path)  # tasks of a worker share it
    monkeypatch.setattr(packing, "_MOST_CACHED", 40)
    monkeypatch.setattr(packing, "_MOST_KEPT", 30)
    plain, encoder, encoded = Tokenizer.from_file(path), packing.Encoder(path), []
    encode_words = encoder._encode_words
    monkeypatch.setattr(encoder, "_encode_words", lambda ws: encoded.extend(ws) or encode_words(ws))
    for k in range(60):
        text = f"x often, again {' '.join(f'rare{k}n{j}' for j in range(5))} {'y' * 60} often again."
        assert encoder(text).tolist() == plain.encode(text, add_special_tokens=False).ids
        assert len(encoder._known) <= 40 and len(encoder._late) <= 40
    assert encoded.count("again") == 1 and encoded.count("rare0n0") == 1
    crowd = " ".join(f"w{j}" for j in range(100))  # too many at once to stay
    assert encoder(crowd).tolist() == plain.encode(crowd, add_special_tokens=False).ids and not encoder._known


def test_sum_of_squares_against_a_plain_version():
    rng = np.random.default_rng(6)
    capacity = 40
    lengths = np.concatenate([rng.integers(1, 41, 150), [40, 40, 1, 1]])
    number, offset = packing.sum_of_squares(lengths, capacity)
    bins: list[list] = []  # number, gap, in the order of opening
    for i in np.argsort(-lengths, kind="stable"):
        size = int(lengths[i])
        gaps = [b[1] for b in bins]
        choices = {}
        for gap in sorted({g for g in gaps if size <= g < capacity}):
            after = list(gaps)
            after[after.index(gap)] -= size
            choices[gap] = sum(after.count(g) ** 2 for g in set(after) - {0})
        if size < capacity and choices:
            gap = min(choices, key=lambda g: (choices[g], g))
            assert capacity - offset[i] == gap
            chosen = next(b for b in bins if b[0] == number[i])
            assert chosen[1] == gap
            chosen[1] -= size
        else:
            assert offset[i] == 0 and number[i] not in {b[0] for b in bins}
            bins.append([number[i], capacity - size])
    assert len(bins) <= 1.1 * -(-lengths.sum() // capacity)


def test_kernel_and_regression_against_plain_ones():
    texts = [("a", prose(k, 12)) for k in range(6)] + [("b", prose(k, 12).replace("w", "é")) for k in range(6, 12)]
    model = string_kernel.fit_kernel(texts, landmarks=8)

    def presence(text):
        return {text.lower()[k : k + n] for n in (1, 2, 3) for k in range(len(text) - n + 1)}

    chosen = [texts[0], texts[6], texts[1], texts[7], texts[2], texts[8], texts[3], texts[9]]
    kernel = lambda x, y: len(presence(x) & presence(y)) / math.sqrt(len(presence(x)) * len(presence(y)))
    asked = [t for _, t in texts[4:9]]
    wanted = np.array([[kernel(t, c) for _, c in chosen] for t in asked])
    assert np.allclose(model.kernel(asked), wanted, atol=1e-5)
    own = np.array([[kernel(x, y) for _, x in chosen] for _, y in chosen])
    against = np.array([[kernel(t, c) for _, c in chosen] for _, t in texts])
    values, vectors = np.linalg.eigh(own)
    whiten = vectors[:, values > 1e-8 * values.max()] / np.sqrt(values[values > 1e-8 * values.max()])
    z, y = against @ whiten, np.array([[float(x == lang) for lang in ("a", "b")] for x, _ in texts])
    centred = z - z.mean(0)
    solved = np.linalg.solve(centred.T @ centred / len(z) + 1e-3 * np.eye(z.shape[1]), centred.T @ (y - y.mean(0)) / len(z))
    assert np.allclose(model.values(asked), (wanted @ whiten - z.mean(0)) @ solved + y.mean(0), atol=1e-3)


def test_prefix_is_lengthened_until_few_candidates_are_expected():
    cells = 1 << jaccard_join.CELL_BITS
    tokens = np.sort(np.random.default_rng(1).integers(0, 1 << 63, 100).astype(np.uint64) * np.uint64(2))
    for count, least_shared in ((1, 1), (9, 5), (200, 20)):
        counts = np.full(cells, count)
        order = jaccard_join.Order(jaccard_join.Order.level(counts), 0)
        prefix, shared = order.prefix(tokens, 80)
        base = 100 - 80 + 1
        assert len(prefix) == base + shared - 1 and shared >= least_shared
        expected = (base + shared - 1) * (np.exp2(int(2048 * np.log2(1 + count)) / 2048) - 2) / shared
        assert expected <= jaccard_join.TARGET or shared == min(80, jaccard_join.MOST_SHARED)


def test_copies_in_large_groups_are_joined(spark):
    """Groups above and below the similarity, with lists of two, three and many classes."""
    rng = np.random.default_rng(12)
    texts = []
    for k, size in enumerate((2, 3, 4, 60)):
        base = prose(300 + k, 150).split()
        for _ in range(size):
            own = list(base)
            for _ in range(int(rng.integers(1, 7))):
                own[int(rng.integers(len(own)))] = f"z{rng.integers(100000)}"
            texts += [" ".join(own)] * int(rng.integers(1, 3))
    line = prose(400, 30)
    texts += [f"{line} {prose(500 + k, 8)}" for k in range(60)]  # share a line, but are not alike
    from tests.llm.test_corpus import jaccard_components

    for size, percent in ((4, 85), (5, 80)):
        roots, _ = jaccard_components(texts, size, percent)
        rows = {r["doc_id"]: r["component_id"] for r in jaccard_join.similar_groups(docs_of(spark, texts).repartition(4), size, percent).collect()}
        assert [rows[k] for k in range(len(texts))] == roots


def _rows_staged(monkeypatch):
    """Counts the rows of what the similarity join stages, by name."""
    counted, stage = {}, jaccard_join.stage

    def counting(df, name, **options):
        out = stage(df, name, **options)
        counted.setdefault(name, []).append(out.count())
        return out

    monkeypatch.setattr(jaccard_join, "stage", counting)
    return counted


@pytest.mark.parametrize("list_rows", [None, 16])
def test_pairs_below_the_threshold_are_ruled_out_inside_a_list(spark, monkeypatch, list_rows):
    rng = np.random.default_rng(12)
    base = prose(600, 150).split()
    ends = [f"end{k}" for k in range(4)]
    texts = []
    for k in range(120):  # any two differ by some words more than links allow, all share rare ones
        own = list(base)
        for at in rng.choice(len(own), int(rng.integers(2, 7)), replace=False):
            own[at] = f"y{k}x{at}"
        texts.append(" ".join([*own, *ends]))
    if list_rows:
        monkeypatch.setattr(jaccard_join, "LIST_ROWS", list_rows)
    counted = _rows_staged(monkeypatch)
    from tests.llm.test_corpus import jaccard_components

    roots, _ = jaccard_components(texts, 4, 85)
    rows = {r["doc_id"]: r["component_id"] for r in jaccard_join.similar_groups(docs_of(spark, texts).repartition(4)).collect()}
    assert [rows[k] for k in range(len(texts))] == roots
    assert len(set(roots)) > 40
    assert counted["possible_pairs"][-1] < len(texts)


def test_copies_in_other_partitions_do_not_make_lists_long(spark, monkeypatch):
    texts = [prose(700, 120), prose(700, 120) + " more", prose(701, 90)] * 8
    counted = _rows_staged(monkeypatch)
    rows = jaccard_join.similar_groups(docs_of(spark, texts).repartition(8)).collect()
    assert {r["doc_id"]: r["component_id"] for r in rows} == {k: 2 if k % 3 == 2 else 0 for k in range(24)}
    assert counted["prefixes"] == [3] and counted["long_lists"] == [0]


def test_words_hashed_together_match_words_split_alone():
    rng = np.random.default_rng(5)
    parts = ["a", "B", "ab", "Ab", " ", "\t", "\n", "\r\x0b\x0c ", "\x1c", "é", "É", "日本", "\xa0", "x" * 40]
    texts = ["".join(rng.choice(parts, rng.integers(0, 30))) for _ in range(2000)] + [None, "", "   ", "one", prose(3, 400_000)]
    found = list(words.hashed_words(pa.array(texts, pa.string())))
    known = {}
    for text, hashes in zip(texts, found, strict=True):
        plain = words.words_of(text)
        assert len(plain) == len(hashes)
        for word, h in zip(plain, hashes.tolist(), strict=True):
            assert known.setdefault(word, h) == h
    assert len(set(known.values())) == len(known)
    assert [len(x) for x in words.hashed_words(pa.array([], pa.string()))] == []


def test_archives_are_read_as_far_as_a_head_announces():
    payload = prose(1, 50_000).encode()
    good = warc.member(1, "u", payload, warc._sha256(payload)[7:], None)
    small = warc.member(2, "v", b"", warc._sha256(b"")[7:], None)
    for block in (1 if len(good) < 1000 else 97, 4096, 1 << 20):
        found = list(warc.records(io.BytesIO(small + good + small), block=block))
        assert [r.payload for r in found] == [b"", payload, b""]
    assert list(warc.records(io.BytesIO(b""))) == []
    for cut in (1, 20, len(good) // 2, len(good) - 1):
        with pytest.raises(ValueError):
            list(warc.records(io.BytesIO(small + good[:cut])))
    pack = lambda raw: gzip.compress(raw)
    raw = gzip.decompress(good)
    for wrong in (raw + b"x", raw[:-1], raw.replace(b"WARC/1.1", b"WARC/9.9", 1), raw.replace(b"\r\n\r\n", b"\r\n", 1)[:300], b"WARC/1.1\r\n" + b"a" * (2 << 20)):
        with pytest.raises(ValueError):
            list(warc.records(io.BytesIO(pack(wrong))))
    taken = io.BytesIO(good)
    member = warc._Member(taken, b"", 512)
    assert b"WARC-Type: response" in member.until(b"\r\n\r\n", warc.MOST_HEAD) and taken.tell() <= 1024


def test_every_language_is_learned(spark):
    rows = [(k, prose(k, 30), "en") for k in range(300)] + [(1000 + k, "0123 " * 1000 + "éàü " * 30, f"l{k % 230}") for k in range(920)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    sample = string_kernel.training_sample(docs, per_language=20, rows=400)
    known = {r["lang"] for r in docs.where(~string_kernel.held_out(4)).select("lang").distinct().collect()}
    assert {lang for lang, _ in sample} == known and len(sample) <= 2 * 400
    assert all(any(map(str.isalpha, text)) for _, text in sample)
    assert string_kernel.training_sample(docs.limit(0)) == []
