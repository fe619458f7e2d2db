"""Every corpus operator against brute force on small tables, and its edge cases."""

import math
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from fixtrail.llm import chunk_dedup, html_trees, lattice_lm, line_crf, packing, string_kernel, warc
from fixtrail.llm.jaccard_join import one_of_each, similar_groups
from fixtrail.llm.mixing import mix, mixed_rows
from fixtrail.llm.permutation_index import search

DOCS = "doc_id long, text string, lang string, source string, n_chars long, words string, _key string"


def docs_of(spark, texts, sources=("a", "b", None)):
    rows = [(k, t, "en", sources[k % len(sources)], len(t or ""), "x", "y") for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def prose(seed, n):
    rng = np.random.default_rng(seed)
    return " ".join("w%d" % w for w in rng.integers(0, 5000, n))


EDGE = [None, "", "   \n ", "one", "a b c", prose(1, 80), prose(1, 80), prose(2, 9000)]


def test_mix_comes_near_targets(spark):
    docs = docs_of(spark, [*EDGE, *[prose(k, 40 + k) for k in range(10, 60)]])
    rows = mix(docs).collect()
    assert len(rows) == 58
    by = {}
    for r in rows:
        assert 0 <= r["taken"] <= 2 * r["size"]
        by.setdefault((r["source"], r["target"], r["source_size"]), []).append(r)
    total = sum(s for _, _, s in by)
    assert math.isclose(sum(t for _, t, _ in by), 1.5 * total, rel_tol=1e-9)
    for (_, target, _), own in by.items():
        assert abs(sum(r["taken"] for r in own) - target) <= max(r["size"] for r in own)
    again = {(r["doc_id"], r["taken"]) for r in mix(docs.repartition(3)).collect()}
    assert again == {(r["doc_id"], r["taken"]) for r in rows}
    assert mixed_rows(docs).columns == docs.columns
    assert mix(docs.limit(0)).count() == 0


def test_mix_shares_the_rest_among_equal_rows(spark):
    docs = spark.createDataFrame([(1, prose(1, 30), s) for s in "ab" for _ in range(20)], "doc_id long, text string, source string")
    rows = mix(docs, weights=(5, 1), share=0.5).collect()
    for s in "ab":
        own = [r for r in rows if r["source"] == s]
        assert len({r["taken"] for r in own}) == 1
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= len(own)


def test_warc_round_trip(spark):
    big = "<p>" + "ä" * 200 + "</p>"
    rows = [(5, "u5", big), (2, "u2", big), (3, None, None), (4, "u4", "<p>x</p>"), (6, "u6", "<p>x</p>"), (7, "u7", big), (7, "u7", big)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    out = {r["page_id"]: r for r in warc.read_archives(warc.write_archives(pages)).collect()}
    assert {k: (r["record_type"], r["refers_to"]) for k, r in out.items()} == {
        2: ("response", None), 5: ("revisit", 2), 7: ("revisit", 2), 3: ("response", None), 4: ("response", None), 6: ("response", None),
    }
    assert bytes(out[2]["payload"]).decode() == big and out[5]["payload_bytes"] == len(big.encode())
    assert warc.read_archives(warc.write_archives(pages.limit(0))).count() == 0


def test_warc_reader_finds_damage():
    import io

    good = warc.member(1, "u", b"payload", warc._sha256(b"payload")[7:], None)
    assert [r.payload for r in warc.records(io.BytesIO(good + good), block=7)] == [b"payload"] * 2
    with pytest.raises(ValueError):
        list(warc.records(io.BytesIO(good[:-4])))
    wrong = warc.member(1, "u", b"payload", "0" * 64, None)
    with pytest.raises(ValueError):
        list(warc.records(io.BytesIO(wrong)))


def test_line_field():
    field = line_crf.fit_field([])
    clean = "\n".join(prose(k, 12) + "." for k in range(12))
    assert line_crf.judge(clean, field)[-1]
    junk = " ".join(f"word{k}*** next{k}%%%" for k in range(60))
    assert not line_crf.judge(junk, field)[-1]
    assert line_crf.judge(None, field)[:6] == (0, 0, 0, 0, 0, True)
    words = "a b c a b c d".split()
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {k + j for k in range(5) for j in range(3) if windows[tuple(words[k : k + 3])] > 1}
    assert line_crf.repeat_words([w.encode() for w in words]) == len(covered)
    # Viterbi against all labellings
    x = np.random.default_rng(3).normal(size=(7, len(line_crf.FEATURES)))
    best = max(
        ([bool(m >> k & 1) for k in range(7)] for m in range(128)),
        key=lambda y: sum(g for g, l in zip(x @ field.weights, y) if l) + field.stay * sum(a == b for a, b in zip(y, y[1:])),
    )
    assert field.decode(x).tolist() == best


def jaccard_components(texts, size, percent):
    sets = []
    for t in texts:
        w = (t or "").lower().split()
        sets.append({tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))} if w else set())
    root = list(range(len(texts)))
    find = lambda k: k if root[k] == k else find(root[k])
    for a in range(len(texts)):
        for b in range(a):
            i, u = len(sets[a] & sets[b]), len(sets[a] | sets[b])
            if i and 100 * i >= percent * u:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return [find(k) for k in range(len(texts))], [len(s) for s in sets]


def test_similarity_join_against_all_pairs(spark):
    rng = np.random.default_rng(0)
    texts = list(EDGE)
    for k in range(12):
        base = prose(100 + k, 60 + 10 * k).split()
        for _ in range(8):
            own = list(base)
            for _ in range(int(rng.integers(0, 5))):
                own[int(rng.integers(len(own)))] = f"z{rng.integers(1000)}"
            texts.append(" ".join(own))
    docs = docs_of(spark, texts)
    roots, sizes = jaccard_components(texts, 4, 85)
    rows = {r["doc_id"]: r for r in similar_groups(docs, 4, 85).collect()}
    assert [rows[k]["component_id"] for k in range(len(texts))] == roots
    assert [rows[k]["n_shingles"] for k in range(len(texts))] == sizes
    kept = one_of_each(docs, 5, 80)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(jaccard_components(texts, 5, 80)[0]))
    assert similar_groups(docs.limit(0)).count() == 0


def test_main_text():
    model = html_trees.fit_extractor([])
    page = "<nav><a href=/>Home</a></nav><article><h1>Title</h1><p>First &amp; <b>bold\n text.<p>Second paragraph, longer than the first.</article><footer>Foot</footer>"
    nodes = html_trees.parse(page)
    labels = html_trees.decode(nodes, model.logit(html_trees.features(nodes)))
    assert [n.text for n, y in zip(nodes, labels) if y and n.text] == ["Title", "First & bold text.", "Second paragraph, longer than the first."]
    for k, n in enumerate(nodes[1:], 1):
        assert not labels[k] or labels[n.parent]
    for page in (None, "", "<", "<p", "text only", "<!-- open", "<script>x", "</div></p>", "<p>" * 2000):
        nodes = html_trees.parse(page)
        assert len(html_trees.decode(nodes, model.logit(html_trees.features(nodes)))) == len(nodes)


def test_packing(spark):
    special = "a  b <|endoftext|> tab\tnew\n line   three é " + "x" * 300
    texts = [*EDGE, special, *[prose(k, 150) for k in range(30)]]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    ids = [[*tokenizer.encode(t or "", add_special_tokens=False).ids, 0] for t in texts]
    rows = packing.pack_documents(docs_of(spark, texts), shard_pieces=16).collect()
    assert sum(r["length"] for r in rows) == sum(map(len, ids))
    sequences = {}
    for r in rows:
        own = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert r["ids"] == own and r["ids_crc32"] == zlib.crc32(np.array(own, "<u4").tobytes())
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048
    assert packing.cut(5000, 2048) == [(0, 904), (904, 2048), (2952, 2048)]
    assert packing.pack_documents(docs_of(spark, texts).limit(0)).count() == 0


def test_neighbours(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(600, 16))
    x[100:160] = x[100]
    rows = [(k, v.tolist()) for k, v in enumerate(x)] + [(900, None), (901, []), (902, [0.0] * 16), (903, [math.nan] * 16), (904, [None] * 16)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    ids = table.where("vec_id % 20 = 0").select("vec_id")
    found = {}
    for r in search(table, ids, pivots=64, prefix=32, shard_rows=300, candidates=150).collect():
        found.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    hits = 0
    for q in range(0, 600, 20):
        scores = x @ x[q]
        best = [k for k in np.lexsort((np.arange(600), -scores)) if k != q][:20]
        own = [found[q][k] for k in range(1, 21)]
        hits += len({v for v, _ in own} & set(best))
        assert all(math.isclose(s, scores[v], abs_tol=1e-12) for v, s in own)
    assert hits >= 0.9 * 600 and set(found) == set(range(0, 600, 20))
    assert [v for v, _ in (found[100][k] for k in range(1, 21))] == list(range(101, 121))
    assert search(table.limit(0), ids.limit(0)).count() == 0


def test_languages():
    sample = [("aa", f"abab baba abba {k}") for k in range(6)] + [("zz", f"xyz zyx yzx {k}") for k in range(6)]
    model = string_kernel.fit_kernel(sample)
    names, scores = model.label(["ab ba abab", "zyx xyz", None, "", "123 !?", "AB"])
    assert names == ["aa", "zz", "und", "und", "und", "aa"] and all(0 <= s <= 1 for s in scores)
    assert string_kernel.fit_kernel([]).label(["abc"]) == (["und"], [0.0])
    long = "ab" * 70_000
    assert set(string_kernel.grams(long)) == set(string_kernel.grams("abab"))


def test_passages(spark):
    shared = prose(7, 70)
    texts = [f"{prose(20 + k, 60)} {shared} {prose(40 + k, 45)}" for k in range(6)] + EDGE + [prose(k, 120) for k in range(70, 76)]
    docs = docs_of(spark, texts)
    out = {r["doc_id"]: r for r in chunk_dedup.dedup_passages(docs).collect()}
    assert out[0]["text"] == texts[0]
    middle = " ".join(shared.split()[20:50])
    for k in range(1, 6):
        assert middle not in out[k]["text"] and sum(s["words"] for s in out[k]["removed"]) >= 30
        assert out[k]["text"].startswith(" ".join(texts[k].split()[:60]))
    for k in (6, 7, 8, 9, 10, 11, 13, *range(14, 20)):
        assert out[k]["text"] == texts[k]
    assert out[12]["text"] == ""
    assert chunk_dedup.dedup_passages(docs.limit(0)).count() == 0


def cut_by_all_windows(texts, least=51):
    """Words left of every text: all windows of ``least`` words against all earlier texts."""
    seen, left = {}, []
    for k, text in enumerate(texts):
        words = (text or "").split()
        windows = [tuple(words[i : i + least]) for i in range(len(words) - least + 1)]
        gone = {i + j for i, w in enumerate(windows) if seen.get(w, k) < k for j in range(least)}
        for w in windows:
            seen.setdefault(w, k)
        left.append([w for i, w in enumerate(words) if i not in gone])
    return left


def test_passages_exactly(spark):
    texts = [f"{prose(300 + k, 20)} {prose(200 + k // 2, 51)} {prose(500 + k, 15)}" for k in range(80)]  # 51 words in pairs
    texts += [f"{prose(700 + k, 20)} {prose(600 + k // 2, 50)} {prose(900 + k, 15)}" for k in range(20)]  # 50 words stay
    line = prose(42, 60)
    texts += [f"{line} {prose(43, 9)} {line}", "no " * 70, f"x {'no ' * 200} y", "yes " * 300]  # repeats in one document stay
    pieces = [prose(50 + k, 30) for k in range(4)]
    texts += [*(f"{p} {prose(60, 9)}" for p in pieces), " ".join(pieces)]  # no single passage behind the last
    texts += [f"{prose(80, 30)} {prose(81, 200)}", f"{prose(81, 200)} {prose(82, 30)}", prose(81, 120)]
    docs = docs_of(spark, texts).repartition(5)
    out = {r["doc_id"]: r for r in chunk_dedup.dedup_passages(docs).collect()}
    wanted = cut_by_all_windows(texts)
    assert [out[k]["text"].split() for k in range(len(texts))] == wanted
    assert [len(w) for w in wanted[:4]] == [86, 35, 86, 35] and len(wanted[100]) == 129 and len(wanted[108]) == 120
    for k, text in enumerate(texts):
        assert sum(x["words"] for x in out[k]["removed"]) == len(text.split()) - len(wanted[k])
        assert all(len(text[x["start"] :][: x["length"]].split()) == x["words"] for x in out[k]["removed"])


def test_clean_documents_keep_all_words(spark):
    shared = prose(1, 50)
    texts = [f"{prose(10, 30)} {shared} {prose(11, 30)}", f"{prose(12, 30)} {shared} {prose(13, 30)}", f"{prose(2, 70)} z {prose(2, 70)}"]
    rows = chunk_dedup.dedup_passages(docs_of(spark, texts)).orderBy("doc_id").collect()
    assert [r["text"] for r in rows] == texts and not any(r["removed"] for r in rows)


def test_lattice_scores(spark, tmp_path):
    texts = [*EDGE[:6], *[prose(k % 5, 30) + " ünïcode \U0001f600" for k in range(20)]]
    docs_of(spark, texts).write.parquet(str(tmp_path / "d"))
    rows = {r["doc_id"]: r for r in lattice_lm.score_documents(spark.read.parquet(str(tmp_path / "d"))).collect()}
    train = [k for k in range(len(texts)) if zlib.crc32(str(k).encode()) % 7 != 2]
    counts = Counter(w for k in train for w in (texts[k] or "").lower().split() + ["\n"])
    start, expected = lattice_lm.start_lattice(), Counter()
    for w, n in counts.items():
        for piece, share in start.expected(w) if w != "\n" else ():
            for key in [piece] if isinstance(piece, str) else piece:
                expected[key] += share * n
    total = sum(counts.values())
    model = lattice_lm.refit(start, expected, len(train))
    for k, text in enumerate(texts):
        words = (text or "").lower().split()
        base = sum(math.log10((counts[w] + 1) / (total + len(counts) + 1)) for w in [*words, "\n"])
        score = (sum(model.word(w) for w in words) + model.end) / math.log(10)
        r = rows[k]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(words) + 1, sum(counts[w] > 0 for w in [*words, "\n"]), total)
        assert math.isclose(r["base_score"], base, rel_tol=1e-9) and math.isclose(r["score"], score, rel_tol=1e-9)


def test_lattice_sums_all_segmentations():
    pieces = {"▁": -2.0, "a": -1.0, "b": -1.5, "▁a": -1.2, "ab": -0.7, "▁ab": -3.0}
    lattice = lattice_lm.Lattice(pieces, [-9.0] * 256, -1.0, 3)

    def every(text):
        if not text:
            return 1.0
        return sum(math.exp(lp) * every(text[len(p) :]) for p, lp in pieces.items() if text.startswith(p))

    assert math.isclose(lattice.word("ab"), math.log(every("▁ab")))
    assert math.isclose(sum(s * len(p) for p, s in lattice.expected("ab")), 3.0)


def test_words_scored_together_match_words_scored_alone():
    lattice = lattice_lm.start_lattice()
    words = ["", "a", "the", "thatthingtion", "ciónóta%%%", "日本語🙂", "\ud800", "x" * 60, "the"]
    counts = np.arange(1, len(words) + 1)
    together = lattice_lm.WordBatch(lattice)
    assert together.scores(words) == pytest.approx([lattice.word(w) for w in words], abs=1e-9)
    wanted: dict[object, float] = {}
    for word, count in zip(words, counts, strict=True):
        for piece, share in lattice.expected(word):
            for key in [piece] if isinstance(piece, str) else piece:
                wanted[key] = wanted.get(key, 0.0) + share * count
    assert dict(together.expected(words, counts)) == pytest.approx(wanted, abs=1e-9)
    assert len(together.scores([])) == 0 and not together.expected([], counts[:0])
