"""Queries that SQL can't express, against brute force over the small tables; parts of the methods on their own."""

import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from lateline.llm import components, line_templates, minhash, mixing, packing, private_data, repeats, syncmers, toxicity
from lateline.llm.cover_tree import grow
from lateline.llm.storage import Scratch
from llm.cases import documents

SF_DIR = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def texts():
    table = pq.read_table(f"{SF_DIR}/documents.parquet", columns=["doc_id", "text"]).to_pydict()
    return dict(sorted(zip(table["doc_id"], (t or "" for t in table["text"]))))


def collected(spark, name):
    return entry.queries()[name](spark, SF_DIR).collect()


def linked(sets):
    """Smallest id reachable over pairs of at least 85 in 100."""
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = [i for i in sets if sets[i]]
    for n, a in enumerate(ids):
        for b in ids[:n]:
            both = len(sets[a] & sets[b])
            if 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: root(i) for i in sets}


def shingles(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_near_copies(spark, texts):
    sets = {i: shingles(t) for i, t in texts.items()}
    want = linked(sets)
    got = {r.doc_id: r for r in collected(spark, "op1_link_documents")}
    assert {i: (r.n_shingles, r.component_id, r.kept) for i, r in got.items()} == {i: (len(s), want[i], want[i] == i) for i, s in sets.items()}


def test_large_group_of_near_copies_is_one_component(spark):
    rng = np.random.default_rng(3)
    base = [f"b{i}" for i in range(400)]
    rows = []
    for n in range(400):
        words = list(base)
        for at in rng.choice(400, 3, replace=False):
            words[at] = f"e{n}-{at}"
        rows.append((n, " ".join(words), "en", "a", 1))
    rows += [(1000 + n, " ".join(f"z{n}-{i}" for i in range(60)), "en", "a", 1) for n in range(50)]
    from lateline.llm.minhash import link_documents

    got = {r.doc_id: r.component_id for r in link_documents(documents(spark, rows)).collect()}
    want = linked({r[0]: shingles(r[1]) for r in rows})
    assert got == want and sum(c == 0 for c in got.values()) > 350


def test_components(spark):
    rng = np.random.default_rng(5)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 200 + i) for i in range(80)] + [tuple(map(int, rng.integers(300, 400, 2))) for _ in range(70)]
    parent = {n: n for e in edges for n in e}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(parent[a], parent[b])
            changed |= (parent[a], parent[b]) != (low, low)
            parent[a] = parent[b] = low
    scratch = Scratch(spark, "test")
    found = spark.createDataFrame([], "node long, component long")
    for part in (edges[::2], edges[1::2]):
        found = components.merged(found, spark.createDataFrame(part, "a long, b long"), scratch, f"m{len(part)}-{part[0]}".replace(" ", ""))
    got = {r.node: r.component for r in found.collect()}
    assert {n: got.get(n, n) for n in parent} == parent


def test_repeats(spark, texts):
    first = {}
    words = {i: WORD.findall(t) for i, t in texts.items()}
    for i, w in words.items():
        for k in range(len(w) - 19):
            first.setdefault(tuple(w[k : k + 20]), (i, k))
    got = {r.doc_id: r for r in collected(spark, "op7_remove_repeats")}
    for i, w in words.items():
        gone = {j for k in range(len(w) - 19) if first[tuple(w[k : k + 20])] < (i, k) for j in range(k, k + 20)}
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        assert (got[i].n_words, got[i].n_removed, got[i].kept_sha256) == (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())


@settings(max_examples=30, deadline=None)
@given(st.lists(st.integers(0, 2**56 - 1), max_size=50, unique=True))
def test_planes_round_trip(values):
    values = np.array(sorted(values), dtype=np.uint64)
    assert (np.cumsum(repeats.from_planes(repeats.to_planes(np.diff(values, prepend=np.uint64(0)), 8), 8)) == values).all()


def test_packing_is_a_round_trip(spark, texts):
    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = collected(spark, "op9_pack_documents")
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for i, text in texts.items():
        ids = [*whole.encode(text, add_special_tokens=False).ids, 0]
        at = 0
        for r in sorted(by_doc[i], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], dtype="<u4").tobytes())
            at += r.length
        assert at == len(ids)
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    total = 0
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024
        total += at
    assert len(by_sequence) <= total / 1024 * 1.02 + 1


@pytest.mark.parametrize("text", ["", " ", "a  b", "a\n b", " a ", "x <|endoftext|> y", "日本 語", "don't I'll", "a\tb \tc", "a" * 3_000, "é ñ ß x", "1234 56.7 $$$ !!"])
def test_fast_ids_are_the_tokenizers_ids(text):
    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = np.array(whole.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
    assert packing.tokenizer_of("byte_bpe_50k").ids(text) == want


@settings(max_examples=40, deadline=None)
@given(st.dictionaries(st.integers(1, 30), st.integers(1, 40), max_size=8), st.integers(0, 60))
def test_closest_fill(counts, room):
    reach = {0}
    for length, n in counts.items():
        reach = {r + length * k for r in reach for k in range(n + 1) if r + length * k <= room}
    used = packing.closest_fill(counts, room)
    assert sum(n * k for n, k in used.items()) == max(reach)
    assert all(k <= counts[n] for n, k in used.items())


@settings(max_examples=40, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 50), min_size=1, max_size=12))
def test_every_length_gets_its_slots(counts):
    slots, filled = packing.pack_lengths(counts, 64), {}
    for n, s in slots.items():
        s.rank.append(counts[n])
        for i, each in enumerate(s.each):
            assert (s.rank[i + 1] - s.rank[i]) % each == 0
            for copy in range((s.rank[i + 1] - s.rank[i]) // each):
                for k in range(each):
                    filled.setdefault(s.sequence[i] + copy, []).append((s.offset[i] + k * n, n))
    for pieces in filled.values():
        assert [o for o, _ in sorted(pieces)] == list(np.cumsum([0, *[n for _, n in sorted(pieces)]])[:-1])
        assert sum(n for _, n in pieces) <= 64
    assert sum(len(p) for p in filled.values()) == sum(counts.values())


def plain_spans(text):
    found = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            found.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m.group())
        doubled = [int(d) * (1 + i % 2) for i, d in enumerate(digits[::-1])]
        if 16 <= len(digits) <= 19 and sum(n // 10 + n % 10 for n in doubled) % 10 == 0:
            found.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            found.append(("phone", *m.span()))
    return found


def test_private_data(spark, texts):
    for r in collected(spark, "op4_find_private_data"):
        base = ",".join(f"{k}:{a}:{b}" for k, a, b in plain_spans(texts[r.doc_id]))
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        spans = [s for s in r.spans.split(",") if s]
        assert set(spans) >= {s for s in base.split(",") if s}
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s.startswith(k + ":") for s in spans) for k in private_data.KINDS]


PIECES = ["a@b.c", "@", ".", "+1 (372) 555-7739", "1.2.3.4", "256.1.1.1", "1.2.3.4.5.6.7.8", "4111 1111 1111 1111", "4111-1111-1111-1112", " ", "x", "a.b%c@d-e.f", "++12", "9" * 20, "0001.2.3.4", "a@b", "é@ü.de"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=12))
def test_patterns_match_their_plain_forms(pieces):
    text = "".join(pieces)
    assert [(private_data.KINDS[k], a, b) for k, a, b in private_data.base_spans(text)] == plain_spans(text)


def test_restored_words():
    words = "the stupid idiot clown is a loser and a moron of pathetic trash " * 50
    counts = np.zeros(toxicity.LETTERS**4)
    seen = toxicity.SYMBOLS[np.frombuffer(f"    {words} ".encode(), dtype=np.uint8)]
    np.add.at(counts, ((seen[:-3] * 28 + seen[1:-2]) * 28 + seen[2:-1]) * 28 + seen[3:], 1)
    restore = toxicity.Restorer(toxicity.letter_costs(counts)).restore
    for said, meant in {"1d10t": "idiot", "i d i o t": "idiot", "m0r0n": "moron", "st*u*p*i*d": "stupid", "stuuupid": "stupid", "l0$er": "loser",
                        "p4th3tic": "pathetic", "t.r.a.s.h": "trash", "iiddiioott": "idiot", "plain words stay": "plain words stay", "a b": "a b"}.items():
        assert restore(said) == meant


def test_toxicity_on_held_out_rows(spark):
    labels = dict(zip(*pq.read_table("/root/testdata/sf0.01/labels.parquet").select(["doc_id", "toxic"]).to_pydict().values()))
    scored = entry.queries()["op6_score_toxicity"](spark, "/root/testdata/sf0.01").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and r.predicted == (r.score >= 0.7) for r in scored)
    pairs = [(r.score, labels[r.doc_id]) for r in scored if r.held_out and r.doc_id in labels]
    good = [s for s, t in pairs if t]
    rest = [s for s, t in pairs if not t]
    assert np.mean([(a > b) + (a == b) / 2 for a in good for b in rest]) > 0.85


def test_fingerprints(spark, texts):
    rows = {r.doc_id: r for r in collected(spark, "op10_fingerprint_documents")}
    order = sorted(texts, reverse=True)
    for i, following in zip(order, order[1:] + order[:1]):
        n = len(texts[i])
        edited = texts[i][: n - n // 3] + texts[following][: n // 3]
        assert rows[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and rows[i].n_chars == n
    prints = {}
    for i, t in texts.items():
        assert prints.setdefault(t, rows[i].fingerprint) == rows[i].fingerprint
    long = [r for r in rows.values() if r.n_chars > 500]
    assert np.mean([r.near_edited > r.near_next for r in long]) > 0.95
    assert np.mean([r.near_edited for r in long]) > 0.4 and np.median([r.near_next for r in long]) < 0.05


def test_anchors_depend_on_their_own_words(spark):
    words = [f"w{i}" for i in range(300)]
    changed = [*words[:100], "other", *words[101:]]
    df = spark.createDataFrame([(" ".join(words), " ".join(changed))], "a string, b string")
    one, other = df.select(syncmers.as_text(syncmers.anchors(df["a"])), syncmers.as_text(syncmers.anchors(df["b"]))).first()
    differing = set(one.split(",")) ^ set(other.split(","))
    assert len(one.split(",")) == syncmers.ANCHORS and len(differing) <= 12


def test_cover_tree_covers_and_separates():
    sample = np.random.default_rng(1).normal(size=(500, 8))
    tree = grow(sample)
    assert len(tree.centres) == 256 and tree.parent[0] == -1 and (tree.parent[1:] < np.arange(1, 256)).all()
    gaps = np.linalg.norm(tree.centres[:, None] - tree.centres[None], axis=2)[np.triu_indices(256, 1)]
    assert gaps.min() >= tree.nearest(sample)[1].min(1).max() - 1e-9


def test_exponent_meets_the_first_goal(spark):
    sizes = spark.createDataFrame([("a", 900, 9), ("b", 90, 9), ("c", 10, 9), ("d", 0, 1)], "mix_source string, source_tokens long, source_docs long")
    by_repeats = mixing.bisect_exponent(sizes, 2.0, 3.0)
    assert by_repeats == pytest.approx(1 - np.log(3) / np.log(90), abs=1e-9)
    by_entropy = mixing.bisect_exponent(sizes, 0.8, 1e9)
    p = np.array([900, 90, 10]) ** by_entropy
    p /= p.sum()
    assert -(p * np.log(p)).sum() == pytest.approx(0.8 * np.log(3), abs=1e-6)
    assert mixing.bisect_exponent(sizes, 2.0, 1e9) == 0.0


def test_near_copies_of_the_pipeline_begin_at_four_fifths(spark):
    words = [f"b{i}" for i in range(260)]
    rows = [(1, " ".join(words), "en", "a", 1)]
    for n, changed in ((2, 5), (3, 7)):  # each change costs five of 256 shingles: 231 of 281 and 221 of 291 in common
        edited = list(words)
        for k in range(changed):
            edited[20 + 30 * k] = f"e{n}-{k}"
        rows.append((n, " ".join(edited), "en", "a", 1))
    near = corpus_pipeline.near_dedup(spark, documents(spark, rows), "")
    assert sorted(r.doc_id for r in near.collect()) == [1, 3]
    kept = minhash.link_documents(documents(spark, rows)).where("kept").collect()
    assert sorted(r.doc_id for r in kept) == [1, 2, 3]
    assert (minhash.Threshold.of(0.85), minhash.Threshold.of(0.8)) == (minhash.Threshold(17, 20, 5, 373), minhash.Threshold(4, 5, 4, 345))


def restorer_of(words):
    counts = np.zeros(toxicity.LETTERS**4)
    seen = toxicity.SYMBOLS[np.frombuffer(f"    {words} ".encode(), dtype=np.uint8)]
    np.add.at(counts, ((seen[:-3] * 28 + seen[1:-2]) * 28 + seen[2:-1]) * 28 + seen[3:], 1)
    return toxicity.Restorer(toxicity.letter_costs(counts))


def test_restored_runs_of_words():
    restorer = restorer_of("you are idiot and you are a stupid idiot and a loser that you are " * 200)
    assert restorer.restore("y o u a r e i d i o t").split() == ["you", "are", "idiot"]
    said = "you are a stupid idiot and a loser and you are a stupid idiot"
    for sign in (" ", ".", "-"):
        spaced = sign.join(said.replace(" ", ""))
        assert len(spaced) > 64 and restorer.restore(spaced).split() == said.split()
    assert len(restorer.known) == 1
    assert restorer.restore("a i d i o t").split() == ["a", "idiot"]
    assert restorer.restore("x" + "*" * 200_000 + "y").replace(" ", "") == "xy"


def test_short_recurring_lines_leave_the_pipeline(spark):
    rows = [(n, f"Read more\n\n{n}\nAdvertisement\nonly w{'abcdefghijkl'[n]} has this", "en", "a", 1) for n in range(12)]
    got = {r.doc_id: r.text for r in corpus_pipeline.line_dedup(spark, documents(spark, rows), "").collect()}
    assert got[0] == rows[0][1]
    assert all(got[n] == f"\n{n}\nonly w{'abcdefghijkl'[n]} has this" for n in range(1, 12))


def test_leaf_with_several_templates(spark):
    names = "ada bea cleo dora eva fay gus hal ida jon kim lea".split()
    rows = []
    for n, name in enumerate(names):
        lines = [f"this page was written by {name} for our site", f"this page was last seen near {name} old town", f"this page was {' '.join(f'{w}{name}' for w in 'pqrstu')}"]
        rows.append((n, "\n".join(lines), "en", "a", 1))
    got = {r.doc_id: r.text for r in corpus_pipeline.line_dedup(spark, documents(spark, rows), "").collect()}
    assert got[0] == rows[0][1]
    assert all(got[n] == rows[n][1].split("\n")[2] for n in range(1, 12))
    kept = line_templates.drop_recurring_lines(documents(spark, [*rows, *rows[:3]]), levels=3)
    assert sorted(r.n_dropped for r in kept.collect()) == [0, 0] + [2] * 13


def test_likeness_of_all_lengths_and_scripts(spark):
    rng = np.random.default_rng(11)
    letters, signs = "abcdefghijklmnopqrstuvwxyz      ", [chr(0x4E00 + i) for i in range(2_000)]
    latin = lambda n: "".join(rng.choice(list(letters), n))
    chinese = "".join(rng.choice(signs, 900))
    near, long = latin(238), latin(303)
    pairs = [
        (near, near + "tail", 0.9), (long, long[:202] + latin(11), 0.5), (chinese, chinese[:600] + "".join(rng.choice(signs, 300)), 0.3),
        (latin(400), latin(200), 0.0),
    ]
    df = spark.createDataFrame([(a, b) for a, b, _ in pairs], "a string, b string").repartition(1)
    got = df.select("a", syncmers.likeness(syncmers.anchors(df["a"]), syncmers.anchors(df["b"]))).collect()
    by_text = {r[0]: r[1] for r in got}
    for a, _, least in pairs:
        assert by_text[a] >= least if least else by_text[a] < 0.05


def test_fingerprints_grow_with_the_text(spark):
    rng = np.random.default_rng(12)
    words = lambda n: [f"w{i}" for i in rng.integers(0, 1_000_000, n)]
    passage = words(400)
    one, other = (" ".join([*words(8_000), *passage, *words(8_000)]) for _ in range(2))
    df = spark.createDataFrame([(one, other)], "a string, b string")
    found = df.select(syncmers.anchors(df["a"]), syncmers.anchors(df["b"])).first()
    hashes = [{x >> syncmers.POSITION_BITS for x in f} for f in found]
    assert min(map(len, hashes)) > 1_000 and len(hashes[0] & hashes[1]) > 15
