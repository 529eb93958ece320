"""Every operator against brute force on small tables with nulls, empty and long texts, ties, repeats and clashing names."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from clickweave.llm import (
    exact_dedup,
    hilbert,
    langid,
    lattice,
    packing,
    piece_lattice,
    pieces,
    simhash,
    suffix_array,
    suffix_dedup,
    trie_counts,
    warc,
)
from clickweave.llm.common import Scratch, components

rng = random.Random(7)
WORDS = ["alpha", "beta", "gamma", "delta", "Été", "naïve", "words", "of", "the", "x1"]


def prose(n, seed):
    own = random.Random(seed)
    return " ".join(own.choice(WORDS) + str(own.randrange(50)) for _ in range(n))


PASSAGE = prose(70, 1)
LONG = prose(6000, 2)
#: (doc_id, text, row, keep_id, n_bytes, source, lang, n_chars): the names in the middle clash with the operators' own.
ROWS = [
    (1, "Same Text Here", "r", 5, "b", "s1", "en", 3),
    (2, "same text here", "r", 5, "b", "s1", "en", 3),
    (2, "same text here", "r", 5, "b", "s1", "en", 3),
    (3, "SAME TEXT HERÉ", None, None, None, None, None, None),
    (4, None, "r", 5, "b", "s2", "en", 3),
    (5, "", "r", 5, "b", "s2", None, 0),
    (None, "no id", "r", 5, "b", "s2", "en", 3),
    (6, "12 34 -- !!", "r", 5, "b", "s3", "en", 3),
    (7, LONG, "r", 5, "b", "s3", "en", len(LONG)),
    (8, LONG.upper(), "r", 5, "b", "s3", "en", len(LONG)),
    (9, prose(30, 3) + " " + PASSAGE + " " + prose(30, 4), "r", 5, "b", "s1", "en", 9),
    (10, prose(30, 5) + " " + PASSAGE + " " + prose(40, 6), "r", 5, "b", "s1", "en", 9),
    (11, "ab" * 700, "r", 5, "b", "s1", "en", 9),
    (12, "é" * 900, "r", 5, "b", "s1", "en", 9),
    (13, prose(200, 8), "r", 5, "b", "s1", "en", 9),
    (14, prose(200, 8) + " end", "r", 5, "b", "s1", "en", 9),
]
SCHEMA = "doc_id bigint, text string, row string, keep_id int, n_bytes string, source string, lang string, n_chars bigint"


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs") / "t")
    spark.createDataFrame(ROWS, SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("none") / "t")
    spark.createDataFrame([], SCHEMA).write.parquet(path)
    return spark.read.parquet(path)


def folded(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def test_exact_duplicates(docs, empty):
    found = exact_dedup.exact_duplicates(docs).collect()
    assert len(found) == len(ROWS)
    groups = defaultdict(list)
    for doc_id, text, *_ in ROWS:
        groups[folded(text)].append(doc_id)
    sizes = Counter((max(g, key=lambda i: (i is not None, i or 0)), len(g)) for g in groups.values() for _ in g)
    assert Counter((r.keep_id_, r.group_size) for r in found) == sizes
    # One row of each group stays, also where ids repeat.
    assert sum(r.kept for r in found) == len(groups)
    assert found[0].row in ("r", None) and hasattr(found[0], "n_bytes")
    assert exact_dedup.exact_duplicates(empty).count() == 0


def test_simhash(docs, empty):
    def brute(text):
        words = re.findall(r"[^\x20\x09-\x0D]+", folded(text))
        shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
        hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))

    prints = [brute(text) for _, text, *_ in ROWS]
    parent = list(range(len(ROWS)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(ROWS)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= 3:
            parent[find(i)] = find(j)
    least = {}
    for i, (doc_id, *_) in enumerate(ROWS):
        if doc_id is not None:
            least[find(i)] = min(doc_id, least.get(find(i), doc_id))
    expected = Counter((d, f"{p:016x}", least.get(find(i))) for i, ((d, *_), p) in enumerate(zip(ROWS, prints)))
    found = simhash.near_duplicates(docs)
    rows = found.select("doc_id", simhash.hex_print(F.col("print")).alias("p"), "component_id", "kept").collect()
    assert Counter((r.doc_id, r.p, r.component_id) for r in rows) == expected
    assert sum(r.kept for r in rows) == len({find(i) for i in range(len(ROWS))})
    assert simhash.near_duplicates(empty).count() == 0


def test_links_within_three_bits(spark):
    base = [rng.getrandbits(64) for _ in range(40)]
    prints = {b ^ sum(1 << i for i in rng.sample(range(64), k)) for b in base for k in (0, 1, 2, 3, 4, 6)}
    frame = spark.createDataFrame([(simhash.signed(p),) for p in prints], "print bigint")
    edges = simhash.near_prints(frame)
    found = {(r.node, r.root) for r in components(edges, Scratch(spark, "t")).collect()}
    parent = {simhash.signed(p): simhash.signed(p) for p in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(prints, 2):
        if (a ^ b).bit_count() <= 3:
            x, y = sorted((find(simhash.signed(a)), find(simhash.signed(b))))
            parent[y] = x
    assert found == {(n, find(n)) for n in parent if find(n) != n}


@pytest.mark.parametrize("group_contents", [1, 1024])
def test_repeats(docs, empty, group_contents, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "GROUP_CONTENTS", group_contents)
    data = [(text or "").encode() for _, text, *_ in ROWS]
    seen = Counter(d[i : i + 400] for d in data for i in range(len(d) - 399))
    expected = Counter()
    for (doc_id, *_), d in zip(ROWS, data):
        covered = bytearray(len(d))
        for i in range(len(d) - 399):
            if seen[d[i : i + 400]] > 1:
                covered[i : i + 400] = b"\1" * 400
        kept = bytes(b for b, c in zip(d, covered) if not c)
        spans = len(re.findall(b"\1+", bytes(covered)))
        expected[doc_id, len(d), sum(covered), spans, hashlib.sha256(kept).hexdigest()] += 1
    found = suffix_dedup.remove_repeats(docs).collect()
    assert Counter((r.doc_id, r.n_bytes_, r.n_removed, r.n_spans, r.kept_sha256) for r in found) == expected
    texts = {r.doc_id: r.text for r in found}
    assert texts[11] == "" and texts[9].startswith(prose(30, 3)) and texts[13] == texts[14][:0]
    assert suffix_dedup.remove_repeats(empty).count() == 0


@pytest.mark.parametrize("seed", range(30))
def test_suffix_arrays(seed):
    own = np.random.default_rng(seed)
    text = own.integers(1, 2 + seed % 4, own.integers(1, 80))
    if seed % 3 == 0:
        text = np.tile(text[:7], 9)
    text = np.append(text, 0).astype(np.uint16)
    plain = text.tolist()
    order = sorted(range(len(plain)), key=lambda i: plain[i:])
    found = suffix_array.suffix_array(text, 6)
    assert found.tolist() == order
    room = np.arange(len(plain))[::-1].copy()
    prefixes, before = suffix_array.common_prefixes(text, found, room)
    for a, b in zip(order, order[1:]):
        n = 0
        while n < min(room[a], room[b]) and plain[a + n] == plain[b + n]:
            n += 1
        assert (before[b], prefixes[b]) == (a, n)


def test_packing(docs, empty):
    from tokenizers import Tokenizer

    encoder = Tokenizer.from_file(f"{packing.tokenizer_folder()}/{packing.TOKENIZER}")
    found = packing.pack(docs, most=64, group_pieces=5).collect()
    ids = sorted(
        (i is not None, i or 0, len(x), zlib.crc32(np.array(x, "<u4").tobytes()))
        for i, x in ((d, [*encoder.encode(t or "", add_special_tokens=False).ids, 2]) for d, t, *_ in ROWS)
    )
    whole = sorted((r.doc_id is not None, r.doc_id or 0, r.length, r.ids_crc32) for r in found if r.piece == 0 and r.length < 64)
    assert set(whole) >= {i for i in ids if i[2] < 64}
    assert sum(r.length for r in found) == sum(i[2] for i in ids)
    lengths = dict((i[1], i[2]) for i in ids)
    for doc_id in (7, 9, 13):
        parts = sorted((r for r in found if r.doc_id == doc_id), key=lambda r: r.piece)
        assert [p.piece for p in parts] == list(range(len(parts)))
        assert [p.start for p in parts] == [0, *itertools.accumulate(p.length for p in parts)][:-1]
        assert sum(p.length for p in parts) == lengths[doc_id] and all(p.length == 64 for p in parts[1:])
    sequences = defaultdict(list)
    for r in found:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 64
    assert packing.pack(empty).count() == 0


def test_tokenisers_agree():
    encode = packing.encoder(packing.tokenizer_folder())
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(f"{packing.tokenizer_folder()}/{packing.TOKENIZER}")
    chars = [chr(i) for i in range(0x250) if chr(i).isprintable() or chr(i) in "\t\n\r\x0b\x0c\x85\xa0"]
    for n in range(300):
        text = "".join(rng.choices(chars, k=n))
        assert encode(text) == whole.encode(text, add_special_tokens=False).ids
    assert encode("a<|endoftext|>b") == whole.encode("a<|endoftext|>b", add_special_tokens=False).ids


def test_sum_of_squares_fills_bins():
    sizes = np.array(sorted([rng.randrange(1, 100) for _ in range(500)], reverse=True))
    bins, offsets = packing.sum_of_squares(sizes, 100)
    fill = np.bincount(bins, weights=sizes)
    assert fill.max() <= 100 and len(fill) <= 1.03 * -(-sizes.sum() // 100) + 1
    for b in range(len(fill)):
        at = 0
        for o, s in sorted(zip(offsets[bins == b], sizes[bins == b])):
            assert o == at
            at += s


def test_language_id(spark, docs, empty):
    spoken = {
        "en": "the cat and the dog went to the house with that man and this woman there",
        "de": "der hund und die katze gingen nach hause mit dem mann und auch der frau über",
        "fr": "le chat et le chien sont allés à la maison avec les hommes et une femme très",
    }
    rows = []
    for lang, line in spoken.items():
        for i in range(120):
            own = random.Random(f"{lang}{i}")
            rows.append((len(rows), " ".join(own.choices(line.split(), k=40)), lang))
    table = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    held = langid.held_out(F.col("doc_id"))
    model = langid.train(table.where(~held))
    assert model.languages == ["de", "en", "fr"]
    found = langid.detect(table, model).where(held).collect()
    assert len(found) > 60 and all(r.lang_pred == r.lang for r in found)
    own = random.Random(3)
    mixed = " ".join(own.choices(spoken["de"].split(), k=300) + own.choices(spoken["fr"].split(), k=100))
    shares = dict(zip(model.languages, model.proportions(mixed)))
    assert abs(shares["de"] - 0.75) < 0.08 and shares["en"] == 0 and abs(sum(shares.values()) - 1) < 1e-6
    odd = {r.doc_id: (r.lang_pred, r.score) for r in langid.detect(docs, model).collect()}
    assert odd[4] == odd[5] == odd[6] == ("und", 0.0) and odd[7][0] in spoken
    assert langid.detect(empty, model).count() == 0
    nothing = langid.train(empty)
    assert nothing.languages == [] and {r.lang_pred for r in langid.detect(docs, nothing).collect()} == {"und"}


@pytest.mark.parametrize("bits, axes", [(1, 3), (2, 2), (3, 3)])
def test_hilbert_curve(spark, bits, axes):
    cells = list(itertools.product(range(2**bits), repeat=axes))
    frame = spark.createDataFrame(cells, [f"x{i}" for i in range(axes)])
    rows = frame.withColumn("h", hilbert.hilbert_index([F.col(c) for c in frame.columns], bits)).collect()
    order = sorted((r.h, tuple(r)[:-1]) for r in rows)
    assert [h for h, _ in order] == list(range(len(cells)))
    assert all(sum(abs(a - b) for a, b in zip(p, q)) == 1 for (_, p), (_, q) in itertools.pairwise(order))


def test_shards(docs, empty):
    found = hilbert.hilbert_shards(docs, shards=5).collect()
    expected = Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t, *_ in ROWS)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in found) == expected
    slots = defaultdict(list)
    for r in found:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(slots[i]) for i in range(5)]
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == len(ROWS)
    curve = [r.curve for r in sorted(found, key=lambda r: (r.shard, r.slot))]
    assert curve == sorted(curve)
    assert hilbert.hilbert_shards(empty).count() == 0


def test_lattice_links(spark):
    own = np.random.default_rng(5)
    rows = []
    for _ in range(12):
        centre = own.normal(size=32)
        for _ in range(8):
            rows.append((len(rows), (centre + own.normal(size=32) * 0.22).astype(np.float32).tolist(), len(rows) % 2))
    rows += [(i, rows[0][1], 0) for i in (900, 900, 901)]
    odd = [(1000, None, 0), (1001, [0.0] * 32, 0), (1002, [float("nan")] * 32, 0), (1003, rows[1][1], None), (1004, [], 1)]
    odd += [(1005, rows[0][1][:16], 0), (None, [1.0, None] * 16, 1)]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows + odd], "vec_id bigint, embedding array<float>, label int, key string, copies int")
    found = lattice.near_duplicates(frame).collect()
    unit = np.array([r[1] for r in rows], np.float64)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    near = (unit @ unit.T >= 0.93) & (np.array([r[2] for r in rows])[:, None] == np.array([r[2] for r in rows])[None])
    np.fill_diagonal(near, False)
    links = Counter()
    for r in found:
        links[r.vec_id] = max(links[r.vec_id], r.n_links)
    true = Counter()
    for i, r in enumerate(rows):
        true[r[0]] = int(near[i].sum())
    assert all(links[i] <= true[i] for i in true) and sum(links.values()) >= 0.9 * sum(true.values()) > 100
    assert {(r.vec_id, r.n_links, r.component_id) for r in found if r.vec_id is None or r.vec_id > 999} == {
        (i, 0, i) for i, *_ in odd
    }
    by = {r.vec_id: r.component_id for r in found}
    assert by[900] == by[901] == by[0] == min(i for i in by if i is not None and by[i] == by[0])
    assert len(found) == len(rows) + len(odd)
    assert lattice.near_duplicates(frame.limit(0)).count() == 0


def test_cells_in_blocks_give_the_same_links(spark, monkeypatch):
    own = np.random.default_rng(6)
    centre = own.normal(size=16)
    rows = [(i, (centre + own.normal(size=16) * 0.15).tolist(), 1) for i in range(120)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    whole = {(r.vec_id, r.n_links, r.component_id) for r in lattice.near_duplicates(frame).collect()}
    monkeypatch.setattr(lattice, "BLOCK", 7)
    assert {(r.vec_id, r.n_links, r.component_id) for r in lattice.near_duplicates(frame).collect()} == whole


def test_piece_counts_and_lattice(docs, empty):
    table = pieces.load_pieces(pieces.default_model())

    def brute(word):
        best = [(0.0, 0)]
        for end in range(1, len(word) + 1):
            options = []
            for start in range(max(0, end - table.longest), end):
                piece = table.pieces.get(word[start:end])
                if piece:
                    options.append((best[start][0] + piece[1], best[start][1] - 1))
            if word[end - 1] not in table.pieces:
                last = best[end - 1]
                options.append((last[0] + table.unknown_score, last[1] - len(word[end - 1].encode())))
            best.append(max(options))
        return -best[-1][1]

    words = {"▁the", "▁them", "▁theme☃", "▁" + "ab" * 300, "▁▁x", "☃", "Été"}
    parts = {p for w in words for p in table.parts(w)}
    assert trie_counts.trie_counts(parts, table) == {p: brute(p) for p in parts}
    counted = {(r.doc_id, r.n_tokens) for r in trie_counts.count_tokens(docs).collect()}
    encoded = piece_lattice.encode(docs)
    rows = encoded.withColumn("back", piece_lattice.decode(F.col("ids"))).collect()
    assert {(r.doc_id, len(r.ids)) for r in rows} == counted and len(rows) == len(ROWS)
    texts = Counter((d, t or "") for d, t, *_ in ROWS)
    assert Counter((r.doc_id, r.back) for r in rows) == texts
    assert all(table.decode(r.ids) == r.back for r in rows if r.ids)
    assert trie_counts.count_tokens(empty).count() == piece_lattice.encode(empty).count() == 0


def test_warc_round_trip(spark, tmp_path):
    big = "<p>" + "é☃\r\n\r\nWARC/1.1\r\n" * 9000 + "</p>"
    rows = [(1, "u 1", "a" * 100), (2, "u2", "a" * 100), (3, None, "a" * 99), (4, "u4", "a" * 99), (5, "u5", None), (6, "u6", "")]
    rows += [(7, "u7", big), (8, "u8", big), (8, "u8", big), (None, "x", big), (9, "u9", "\r\n\r\n"), (10, "u10", "line\r")]
    pages = spark.createDataFrame([(*r, "c", 2) for r in rows], "page_id bigint, url string, html string, chunk string, row int")
    path = str(tmp_path / "archive")
    warc.write_archives(warc.chunks(warc.records(pages), chunk_bytes=1000), path)
    chunks = warc.read_archives(spark, path, chunk_bytes=700)
    found = Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.read_records(chunks).collect())
    firsts = {}
    for i, _, html in rows:
        if i is not None:
            firsts[html] = min(i, firsts.get(html, i))
    expected = Counter()
    for i, _, html in rows:
        data = (html or "").encode()
        first = firsts.get(html)
        again = len(data) >= 100 and first != i
        expected[i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", first if again else None] += 1
    assert found == expected
    parts = chunks.where("page_id = 7").orderBy("chunk").collect()
    assert b"".join(bytes(p.payload) for p in parts).decode() == big and len(parts) > 100
    data = big.encode()
    assert all(p.digest_so_far == hashlib.sha256(data[: p.start + p.chunk_bytes]).hexdigest() for p in parts)
    none = str(tmp_path / "none")
    warc.write_archives(warc.chunks(warc.records(pages.limit(0))), none)
    assert warc.read_records(warc.read_archives(spark, none)).count() == 0


@pytest.mark.parametrize("size", [1, 2, 3, 4, 5, 7, 100, 10_000])
def test_payload_chunks(size):
    for text in (None, "", "a", "é☃𝄞" * 9, "ab\ud800c", "x" * 4000 + "☃" * 500):
        data = (text or "").encode(errors="replace")
        parts = list(warc.parts_of(text, size))
        assert b"".join(p for _, p, _, _ in parts) == data and [last for *_, last in parts] == [False] * (len(parts) - 1) + [True]
        for start, part, digest, _ in parts:
            assert start == 0 or data[start] & 0xC0 != 0x80
            assert len(part) <= max(size, 4) and (part or not data)
            assert digest == hashlib.sha256(data[: start + len(part)]).hexdigest()


def test_many_revisits_are_joined_by_shuffle(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "BROADCAST_ROWS", 0)
    pages = spark.range(300).select(F.col("id").alias("page_id"), F.repeat(F.lit("y"), F.when(F.col("id") % 3 == 0, 200).otherwise(F.col("id").cast("int"))).alias("html"))
    path = str(tmp_path / "a")
    warc.write_archives(warc.chunks(warc.records(pages)), path)
    found = {r.page_id: r.refers_to for r in warc.read_records(warc.read_archives(spark, path)).collect()}
    # 200 is the length of every third payload, and of that of page 200 itself.
    assert found == {i: 0 if i > 0 and (i % 3 == 0 or i == 200) else None for i in range(300)}


def test_broken_archives_are_an_error():
    reader = warc.ArchiveReader(10)
    with pytest.raises(ValueError):
        list(reader.feed(b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 1\r\nWARC-Record-ID: <urn:page:1:0>\r\nX-Payload-Length: 1\r\nWARC-Payload-Digest: sha256:0\r\n\r\nabcdefgh"))
    reader = warc.ArchiveReader(10)
    list(reader.feed(b"WARC/1.1\r\nWARC-Type: resp"))
    with pytest.raises(ValueError):
        reader.close()


def test_texts_of_the_lattice_are_moved_once(docs, spark, tmp_path, monkeypatch):
    """Texts are written nowhere but in the last shuffle, and a part's places in blocks are packed; blocks of any size agree."""
    from clickweave.llm import common

    docs.select("doc_id", "text").write.parquet(f"{tmp_path}/documents.parquet")
    scan = spark.read.parquet(f"{tmp_path}/documents.parquet")
    whole = Counter((r.doc_id, tuple(r.ids)) for r in piece_lattice.encode(scan).collect())
    monkeypatch.setattr(piece_lattice, "BLOCK_BYTES", 20_000)
    monkeypatch.setattr(piece_lattice, "HELD_PLACES", 50)
    monkeypatch.setattr(common, "shared_dir", lambda spark: str(tmp_path / "shared"))
    kept, written = Scratch.keep, []
    monkeypatch.setattr(Scratch, "keep", lambda self, df: written.append(df.columns) or kept(self, df))
    found = piece_lattice.encode(scan)
    assert Counter((r.doc_id, tuple(r.ids)) for r in found.collect()) == whole
    assert written == [["block", "part"], ["block", "payload"]]
    # The parts are gone once their ids are known, and their lists of blocks need no shuffle of their own.
    assert {p.parent.name for p in (tmp_path / "shared").rglob("*.parquet")} == {"2"}
    parts = [b"ab", "é☃".encode(), b"\n", b""]
    ids = [np.array(i, "<i4") for i in ([1], [2, 70000], [3], [])]
    expected = {p.decode(): i.tobytes() for p, i in zip(parts, ids)}
    assert piece_lattice.unpack_lexicon(piece_lattice.pack_lexicon(parts, ids)) == expected


def test_lattices_of_many_parts_are_folded_together():
    """As one by one, ties and characters of no piece included; words are cut as the table cuts them."""
    import random
    from types import SimpleNamespace

    draw, table = random.Random(5), pieces.load_pieces(pieces.default_model())
    strings = sorted({"".join(draw.choices("abc", k=draw.randint(1, 4))) for _ in range(60)})
    ties = SimpleNamespace(
        pieces={p: (i + 300, float(-draw.randint(1, 3))) for i, p in enumerate(strings)},
        longest=max(map(len, strings)),
        joined={p[i : i + 2] for p in strings for i in range(len(p) - 1)},
        unknown_score=-5.0,
        byte_ids=lambda char: list(char.encode()),
    )
    for letters, of in (("abcé☃𝄞", ties), ("▁abehint é☃𝄞漢\n", table)):
        parts = ["".join(draw.choices(letters, k=draw.randint(1, 20))) for _ in range(400)] + ["ab" * 100]
        ids, counts = piece_lattice.Lattice(of).fold(parts)
        ends = np.cumsum(counts).tolist()
        assert [ids[a:b].tolist() for a, b in zip([0, *ends], ends)] == [piece_lattice.best_ids(p, of) for p in parts]
    lattice = piece_lattice.Lattice(table)
    assert lattice.fold([])[0].tolist() == [] and lattice.cut([])[0] == []
    texts = ["", " ", "  ", "a", " a", "a  b ", "▁a ▁", "the\nthe  \n x", "☃é the漢"]
    for text in texts + ["".join(draw.choices("the ▁\né☃", k=30)) for _ in range(300)]:
        keys = piece_lattice.word_keys(text)
        parts, ends = lattice.cut(keys)
        assert parts == [p for w in table.words(text) for p in table.parts(w)]
        assert ends[-1] == len(parts) and len(ends) == len(keys) + 1


def test_parts_of_the_lattice_move_packed(spark, tmp_path, monkeypatch):
    """Not a row each: what is written and shuffled for the parts stays well under the texts' bytes."""
    import random

    draw = random.Random(9)
    words = ["".join(draw.choices("abcdeinorst", k=9)) for _ in range(20_000)]
    rows = [(i, " ".join(draw.choices(words, k=300))) for i in range(400)]
    spark.createDataFrame(rows, "doc_id bigint, text string").repartition(2).write.parquet(f"{tmp_path}/documents.parquet")
    kept, tables = Scratch.keep, []
    monkeypatch.setattr(Scratch, "keep", lambda self, df: tables.append(df.columns) or counts(kept(self, df)))
    n_rows = []

    def counts(df):
        n_rows.append(df.count())
        return df

    found = piece_lattice.encode(spark.read.parquet(f"{tmp_path}/documents.parquet"))
    assert len(tables) == 2 and n_rows[0] < 100
    table = pieces.load_pieces(pieces.default_model())
    some = {r.doc_id: r.ids for r in found.where("doc_id < 5").collect()}
    assert some == {i: [x for w in table.words(t) for p in table.parts(w) for x in piece_lattice.best_ids(p, table)] for i, t in rows[:5]}
    parts = sorted({p.encode() for w in words for p in table.parts("▁" + w)})
    packed = piece_lattice.pack_parts(parts)
    assert piece_lattice.unpack_parts(packed) == parts and len(packed) < sum(map(len, parts))
    assert piece_lattice.unpack_parts(piece_lattice.pack_parts([])) == []


def test_deals_of_the_lattice_are_bounded(docs, spark, tmp_path, monkeypatch):
    """A block has a row for each deal, so deals must not grow with the input for ever; a large one is folded in turns."""
    docs.select("doc_id", "text").write.parquet(f"{tmp_path}/documents.parquet")
    scan = spark.read.parquet(f"{tmp_path}/documents.parquet")
    whole = Counter((r.doc_id, tuple(r.ids)) for r in piece_lattice.encode(scan).collect())
    monkeypatch.setattr(piece_lattice, "DEAL_BYTES", 100)
    monkeypatch.setattr(piece_lattice, "MOST_DEALS", 3)
    monkeypatch.setattr(piece_lattice, "HELD_PLACES", 20)
    kept, deals = Scratch.keep, set()

    def keep(self, df):
        table = kept(self, df)
        if "part" in df.columns:
            deals.update(r.deal for r in table.select("part.deal").collect())
        return table

    monkeypatch.setattr(Scratch, "keep", keep)
    assert Counter((r.doc_id, tuple(r.ids)) for r in piece_lattice.encode(scan).collect()) == whole
    assert deals == {0, 1, 2}
