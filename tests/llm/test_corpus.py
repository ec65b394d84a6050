"""Operators that look across documents, held to brute force; and the pipeline."""

from __future__ import annotations

import base64
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import corpus_pipeline
from conftest import AWKWARD, SF_DIR, sentence
from strata.llm import decontamination, neardup, packing, quality_rules, queries, sharding, suffixes, warc
from strata.session import shared_folder

FILES = packing.public_files()


def cut(rows, depth=100):
    """``(id, bytes, removed, spans, digest)`` by a set of all strings seen so far."""
    seen, result = set(), []
    for doc, text in sorted(rows, key=lambda row: -1 if row[0] is None else row[0]):
        data = (text or "").encode()
        covered = bytearray(len(data))
        for start in range(len(data) - depth + 1):
            window = data[start : start + depth]
            if window in seen:
                covered[start : start + depth] = b"\1" * depth
            seen.add(window)
        kept = bytes(byte for byte, out in zip(data, covered) if not out)
        spans = sum(covered[i] and not (i and covered[i - 1]) for i in range(len(data)))
        result.append((doc, len(data), len(data) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return result


def cut_rows(df):
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    return sorted(map(str, (tuple(row[name] for name in names) for row in df.collect())))


def test_suffix_query(spark, texts):
    got = cut_rows(queries.QUERIES["op1_suffixes"](spark, SF_DIR))
    assert got == sorted(map(str, cut(texts.items())))


def test_suffixes_of_awkward_rows(awkward, no_rows):
    one_each = [row for i, row in enumerate(AWKWARD) if row not in AWKWARD[:i] and row != (None, None)]
    got = set(cut_rows(suffixes.remove_repeats(awkward.where("not (doc_id is null and text is null)"))))
    assert got == set(map(str, cut(one_each)))  # a row given twice counts once
    assert suffixes.remove_repeats(awkward).count() == len(AWKWARD)
    assert suffixes.remove_repeats(no_rows).count() == 0


def test_suffixes_of_random_mosaics(spark):
    """Texts put together from few parts, with repeats at every offset and periods of all kinds."""
    drawn = random.Random(11)
    parts = ["ab" * 90, "x" * 230, *("".join(drawn.choice("abcd") for _ in range(drawn.randint(60, 260))) for _ in range(9))]
    rows = []
    for doc in range(60):
        text = "".join(drawn.choice(parts)[drawn.randint(0, 20) :] for _ in range(drawn.randint(1, 6)))
        rows.append((doc, text))
    df = spark.createDataFrame(rows, "doc_id int, text string").repartition(5)
    got = suffixes.remove_repeats(df, with_kept=True)
    assert cut_rows(got) == sorted(map(str, cut(rows)))
    assert all(hashlib.sha256(row["kept"]).hexdigest() == row["kept_sha256"] for row in got.collect())


def test_long_texts_are_cut_into_pieces(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "CHUNK", 300)
    found = [suffixes._runs_of(chunk, 100) for chunk in suffixes._pieces([sentence(1, 400).encode()] * 2, 100)]
    runs = sorted((i, at, n) for part in found for i, at, n in zip(part["i"], part["at"], part["n"]))
    size = len(sentence(1, 400))
    for doc in (0, 1):
        windows = [at + k for i, at, n in runs if i == doc for k in range(n)]
        assert windows == list(range(size - 99))


def words_of(text):
    return [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]


def similar(one, two):
    def weights(words):
        length = min(5, len(words))
        return Counter(tuple(words[i : i + length]) for i in range(len(words) - length + 1))

    one, two = weights(one), weights(two)
    size = lambda counts: sum(n * sum(map(len, s)) for s, n in counts.items())
    return size(one & two) / max(size(one | two), 1)


def contaminated(docs, items):
    """Best window of every document and item over all places, by sliding."""
    found = {}
    for doc, text in docs:
        words = words_of(text)
        known = {tuple(words[i : i + 5]) for i in range(len(words))}
        for item, question in items:
            asked = words_of(question)
            if not asked or not any(tuple(asked[i : i + 5]) in known for i in range(len(asked))):
                continue
            best = max(similar(words[i : i + len(asked)], asked) for i in range(max(1, len(words))))
            if best >= 0.75:
                found[doc, item] = best
    return found


def test_decontamination_query(spark, texts):
    items = [tuple(row) for row in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    rows = queries.QUERIES["op2_decontamination"](spark, SF_DIR).collect()
    expected = contaminated(texts.items(), items)
    assert {(row["doc_id"], row["item_id"]): pytest.approx(row["similarity"]) for row in rows} == expected


def test_decontamination_of_changed_passages(spark):
    """Items with words changed, dropped and put in, around the threshold."""
    drawn = random.Random(5)
    items = [(i, " ".join(f"q{drawn.randint(0, 400)}" for _ in range(drawn.randint(20, 60)))) for i in range(12)]
    docs = []
    for doc in range(120):
        words = drawn.choice(items)[1].split()
        for _ in range(drawn.randint(0, 3)):
            at = drawn.randrange(len(words))
            words[at : at + drawn.randint(0, 1)] = drawn.choice([[], ["new"], ["Two", "more"]])
        around = [f"z{drawn.randint(0, 999)}" for _ in range(60)]
        docs.append((doc, " ".join(around[:30] + words + around[30:]).capitalize()))
    schema = "{} int, text string"
    found = decontamination.find_items(
        spark.createDataFrame(docs, schema.format("doc_id")), spark.createDataFrame(items, schema.format("item_id"))
    )
    got = {(row["doc_id"], row["item_id"]): row["similarity"] for row in found.collect()}
    expected = contaminated(docs, items)
    sure = {key for key, similarity in expected.items() if similarity >= 0.8}
    assert 40 < len(sure) and sure <= set(got) <= set(expected)
    assert all(similarity <= expected[key] + 1e-9 for key, similarity in got.items())


def test_decontamination_between_alignments(spark):
    """Every match of 0.75 and more, also where the best window starts at no alignment."""
    drawn = random.Random(8)
    items = [(i, " ".join("q" * drawn.randint(1, 9) + str(drawn.randint(0, 400)) for _ in range(drawn.randint(20, 60)))) for i in range(12)]
    docs = []
    for doc in range(600):
        words = drawn.choice(items)[1].split()
        for _ in range(drawn.randint(1, 3)):
            at = drawn.randrange(len(words))
            words[at : at + drawn.randint(0, 1)] = drawn.choice([[], ["new"], ["two", "more"]])
        around = ["z" * drawn.randint(1, 9) + str(drawn.randint(0, 999)) for _ in range(20)]
        docs.append((doc, " ".join(around[:10] + words + around[10:])))
    schema = "{} int, text string"
    found = decontamination.find_items(
        spark.createDataFrame(docs, schema.format("doc_id")), spark.createDataFrame(items, schema.format("item_id"))
    )
    got = {(row["doc_id"], row["item_id"]): pytest.approx(row["similarity"]) for row in found.collect()}
    assert got == contaminated(docs, items)


def test_decontamination_edges(spark, awkward, no_rows):
    items = spark.createDataFrame(
        [(1, None, "x"), (2, "", "x"), (3, "one", "x"), (4, sentence(2, 60), "x"), (4, sentence(2, 60), "x"), (None, sentence(3, 30), "x")],
        "item_id bigint, text string, start string",
    )
    got = {(row["doc_id"], row["item_id"]) for row in decontamination.find_items(awkward, items).collect()}
    assert {(4, 3), (5, 4), (6, 4), (13, 4), (None, None)} <= got and not any(doc in (1, 2, 3, 8) for doc, _ in got)
    assert decontamination.find_items(no_rows, items).count() == 0
    assert decontamination.find_items(awkward, items.limit(0)).count() == 0
    clean = decontamination.without_items(awkward, items)
    assert clean.columns == awkward.columns and clean.count() == len(AWKWARD) - sum(
        doc in {d for d, _ in got} for doc, _ in AWKWARD
    )


def check_packing(rows, texts, capacity=2048):
    whole = packing.Encoder(FILES["tokenizer_path"], None)
    ids = [(doc, np.frombuffer(whole.encode(text or ""), "<u4").tolist() + [0]) for doc, text in texts]
    expected = []
    for doc, tokens in ids:
        first = len(tokens) if len(tokens) <= capacity else len(tokens) % capacity or capacity
        starts = [0, *range(first, len(tokens), capacity)]
        for piece, (a, b) in enumerate(zip(starts, [*starts[1:], len(tokens)])):
            expected.append((doc, piece, a, b - a, zlib.crc32(np.array(tokens[a:b], "<u4").tobytes())))
    got = [tuple(row[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32")) for row in rows]
    assert sorted(map(str, got)) == sorted(map(str, expected))
    sequences = defaultdict(list)
    for row in rows:
        sequences[row["sequence_id"]].append((row["offset"], row["length"]))
    for parts in sequences.values():
        parts.sort()
        assert [offset for offset, _ in parts] == [sum(n for _, n in parts[:i]) for i in range(len(parts))]
        assert sum(n for _, n in parts) <= capacity
    return len(sequences), -(-sum(row["length"] for row in rows) // capacity)


def test_packing_query(spark, texts):
    used, least = check_packing(queries.QUERIES["op3_packing"](spark, SF_DIR).collect(), texts.items())
    assert used <= least + 1


def test_packing_of_awkward_rows(awkward, no_rows):
    check_packing(packing.pack_documents(awkward, **FILES).collect(), AWKWARD)
    assert packing.pack_documents(no_rows, **FILES).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 3), max_size=6), st.integers(0, 60))
def test_fullest_bin(counts, space):
    sums = {0}
    for length, count in counts.items():
        sums = {s + k * length for s in sums for k in range(count + 1)}
    chosen = packing.fullest(counts, space)
    assert sum(chosen) == max(s for s in sums if s <= space) and not Counter(chosen) - Counter(counts)


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="ab .'s\n\t\x1f\x85  é日１\U0001f600<|endoftext|>", max_size=40))
def test_both_token_ways_agree(text):
    assert packing.encoder(**FILES).encode(text) == packing.encoder(FILES["tokenizer_path"], None).encode(text)


def grouped(rows):
    """``{id: (shingles, least id reachable)}`` by comparing all pairs."""
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    sets = {}
    for doc, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(lower))
        length = min(5, len(words))
        sets[doc] = {tuple(words[i : i + length]) for i in range(len(words) - length + 1)} if words else set()
    least = {doc: doc for doc in sets}
    order = sorted(sets, key=lambda doc: -1 if doc is None else doc)

    def top(doc):
        while least[doc] != doc:
            doc = least[doc]
        return doc

    for i, a in enumerate(order):
        for b in order[i + 1 :]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 75 * (len(sets[a]) + len(sets[b]) - common):
                one, two = sorted((top(a), top(b)), key=order.index)
                least[two] = one
    return {doc: (len(sets[doc]), top(doc)) for doc in sets}


def test_near_duplicate_query(spark, texts):
    rows = queries.QUERIES["op7_neardup"](spark, SF_DIR).collect()
    assert {row["doc_id"]: (row["n_shingles"], row["component_id"]) for row in rows} == grouped(texts.items())
    assert all(row["kept"] == (row["doc_id"] == row["component_id"]) for row in rows) and len(rows) == len(texts)


def test_near_duplicates_of_awkward_rows(awkward, no_rows):
    some = [row for row in AWKWARD if row != (None, None)]
    rows = neardup.near_duplicates(awkward.where("not (doc_id is null and text is null)")).collect()
    assert {row["doc_id"]: (row["n_shingles"], row["component_id"]) for row in rows} == grouped(some)
    assert neardup.near_duplicates(awkward).count() == len(AWKWARD)
    assert neardup.near_duplicates(no_rows).count() == 0
    kept = neardup.without_duplicates(awkward)
    assert kept.columns == awkward.columns and {5, 1, 2, 3, 4} <= {row["doc_id"] for row in kept.collect()}


def test_stars_and_chains_hold_together(spark):
    """A family whose members are near its base only, a chain, and a crowd of close copies."""
    drawn, rows = random.Random(2), []
    base = [f"b{i}" for i in range(200)]
    for doc in range(60):
        words = base.copy()
        for at in drawn.sample(range(200), 5):
            words[at] = f"v{doc}x{at}"
        rows.append((doc, " ".join(words)))
    rows.append((500, " ".join(base)))
    chain = [f"c{i}" for i in range(400)]
    rows += [(600 + k, " ".join(chain[15 * k : 15 * k + 150])) for k in range(12)]
    crowd = [f"d{i}" for i in range(150)]
    for doc in range(150):
        words = crowd.copy()
        words[doc] = "changed"
        rows.append((1000 + doc, " ".join(words)))
    drawn.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
    got = {row["doc_id"]: row["component_id"] for row in neardup.near_duplicates(df).collect()}
    assert got == {doc: component for doc, (_, component) in grouped(rows).items()}


@pytest.mark.parametrize(("common", "extra"), [(228, 33), (242, 19), (253, 8)])
def test_pairs_in_crowds(spark, common, extra):
    """A passage in 240 texts of 300 shingles, at 0.6 to 0.72 to each other, and pairs at 0.75 to 0.8."""
    drawn, rows = random.Random(common), []
    passage = [f"p{i}" for i in range(common)]
    for pair in range(120):
        also = [f"s{pair}x{i}" for i in range(extra + pair % 7 if pair % 3 else 0)]
        for doc in (2 * pair, 2 * pair + 1):
            own = [f"o{doc}x{i}" for i in range(304 - common - len(also))]
            rows.append((doc, " ".join(passage + also + own)))
    drawn.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
    got = {row["doc_id"]: row["component_id"] for row in neardup.near_duplicates(df).collect()}
    expected = {doc: component for doc, (_, component) in grouped(rows).items()}
    assert 60 < sum(doc != component for doc, component in expected.items()) <= 80
    assert got == expected


def test_components(spark):
    drawn = random.Random(4)
    links = [(i, i + 1) for i in range(60)] + [(drawn.randint(100, 160), drawn.randint(100, 160)) for _ in range(50)]
    least = {node: node for link in links for node in link}
    for _ in least:
        for a, b in links:
            least[a] = least[b] = min(least[a], least[b])
    df = spark.createDataFrame([(max(x), min(x)) for x in links], "a bigint, b bigint")
    assert {row["id"]: row["component"] for row in neardup.components(df).collect()} == least
    assert neardup.components(df.limit(0)).count() == 0


def check_shards(rows, texts, sources, n=16):
    assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in rows) == sorted(
        (str(doc), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for doc, t in texts
    )
    shards = defaultdict(list)
    for row in rows:
        shards[row["shard"]].append(row)
    sizes = [len(shards[k]) for k in range(n)]
    assert max(sizes) - min(sizes) <= 1 and set(shards) <= set(range(n))
    for shard in shards.values():
        assert sorted(row["slot"] for row in shard) == list(range(len(shard)))
    for source, total in Counter(sources).items():
        for k in range(n):
            held = sum(row["source"] == source for row in shards[k])
            assert abs(held - total * sizes[k] / max(len(rows), 1)) <= 2


def test_shards(docs, texts, awkward, no_rows):
    rows = sharding.interleave(docs).collect()
    check_shards(rows, texts.items(), [row["source"] for row in rows])
    again = sharding.interleave(docs.repartition(7)).collect()
    assert sorted(map(str, again)) == sorted(map(str, rows))
    rows = sharding.interleave(awkward).collect()
    check_shards(rows, AWKWARD, [row["source"] for row in rows])
    assert sharding.interleave(no_rows).count() == 0


def test_shard_query(spark, texts):
    rows = queries.QUERIES["op8_sharding"](spark, SF_DIR).collect()
    assert len(rows) == len(texts) and {row["law"] for row in rows} == {"rows"}


PAGES = "page_id bigint, url string, html string, id string, address string, header string"


def archived(rows):
    first = {}
    for page, _, html in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        first.setdefault((html or "").encode(), page)
    for page, _, html in rows:
        data = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        revisit = first[data] != page
        yield page, len(data), digest, "revisit" if revisit else "response", first[data] if revisit else None


def test_archive_query(spark):
    pages = [tuple(row) for row in spark.read.parquet(f"{SF_DIR}/pages.parquet").select("page_id", "url", "html").collect()]
    rows = queries.QUERIES["op9_warc"](spark, SF_DIR).collect()
    assert sorted(tuple(row)[:5] for row in rows) == sorted(archived(pages)) and all(row["intact"] for row in rows)


def test_archive(spark):
    pages = [
        (4, "http://a/", "same"), (2, "http://b/\r\nWARC-Type: fake", "same"), (9, None, "same"), (1, "", None),
        (3, "u", ""), (5, "u", "ä" * 50_000), (6, "v", "six"), (None, "w", "same"),
    ]
    df = spark.createDataFrame([(*page, "x", "x", "x") for page in pages], PAGES)
    folder = warc.write_archive(df, shared_folder(spark, "test"))
    got = [(r["id"], *tuple(r)[2:6]) for r in warc.resolve(spark, folder).collect()]
    assert sorted(map(str, got)) == sorted(map(str, archived(pages)))
    assert spark.read.parquet(f"{folder}/payloads").count() == 4
    records = {row["id"]: bytes(row["record"]) for row in warc.read_responses(spark, folder).collect()}
    for page, url, html in pages:
        if page in records:
            head, _, rest = records[page].partition(b"\r\n\r\n")
            assert rest == (html or "").encode() + b"\r\n\r\n" and head.startswith(b"WARC/1.1\r\n")
            assert f"Content-Length: {len((html or '').encode())}".encode() in head
            assert head.count(b"WARC-Type") == 1 + ((url or "").count("WARC-Type"))
    short = warc.write_archive(df, shared_folder(spark, "test"), min_bytes=5)
    kinds = {row["id"]: row["record_type"] for row in warc.resolve(spark, short).collect()}
    assert set(kinds.values()) == {"response"}
    empty = warc.write_archive(df.limit(0), shared_folder(spark, "test"))
    assert warc.resolve(spark, empty).count() == 0


def test_damaged_payload_is_noticed(spark):
    df = spark.createDataFrame([(1, "u", "one"), (2, "v", "two")], "page_id int, url string, html string")
    folder, other = (warc.write_archive(df.limit(n), shared_folder(spark, "test")) for n in (2, 1))
    spark.read.parquet(f"{other}/payloads").write.mode("overwrite").parquet(f"{folder}/payloads")
    with pytest.raises(Exception, match="missing or differs"):
        warc.resolve(spark, folder).collect()


def test_pipeline(spark, docs, texts):
    """Every stage on what its predecessor kept, against the brute-force answers above."""
    now, columns = docs, docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, SF_DIR).cache()
        assert now.columns == columns
        kept[name] = {row["doc_id"]: row["text"] for row in now.collect()}
        assert all(row["n_chars"] == len(row["text"]) for row in now.collect())
    first, second, third, fourth = kept.values()
    assert set(second) == {doc for doc, (_, least) in grouped(first.items()).items() if doc == least}
    items = [tuple(row) for row in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    assert set(third) == set(second) - {doc for doc, _ in contaminated(second.items(), items)}
    assert set(fourth) == set(third) and not any(re.search(r"\w@mail\d", text) for text in fourth.values())
    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    check_packing(rows, fourth.items())


def test_stages_on_awkward_rows(spark, awkward, no_rows):
    folder = shared_folder(spark, "tables")
    spark.createDataFrame([(1, sentence(7, 30))], "item_id int, text string").write.parquet(f"{folder}/benchmark.parquet")
    found = {}
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, no_rows, folder).count() == 0
        result = stage(spark, awkward, folder)
        assert name == "packing" or result.columns == awkward.columns
        found[name] = sorted(str(row["doc_id"]) for row in result.collect())
    every = sorted(str(doc) for doc, _ in AWKWARD)
    passed = quality_rules.judge(awkward).where("kept").collect()
    assert found["quality rules"] == sorted(str(row["doc_id"]) for row in passed)
    # BASE is the text of 5 and of both rows of 6, and 7 is near it; the texts without words belong to no group
    assert found["near-duplicates"] == [doc for doc in every if doc not in ("6", "7")]
    assert found["decontamination"] == found["personal data"] == every
    assert set(found["packing"]) == set(every) and len(found["packing"]) >= len(every)
