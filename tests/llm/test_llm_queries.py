"""Registered queries against brute force, or their SQL, on the smallest tables."""

import collections
import hashlib
import math
import re
import zlib

import pytest
from oracle_compare import compare, oracle_connection

from semlayer.llm import pii
from semlayer.llm.queries import ORACLE, QUERIES, tokenizer_path

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    return {row.doc_id: row.text or "" for row in rows}


def result(spark, name):
    return QUERIES[name](spark, FOLDER).collect()


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_against_sql(spark, name):
    assert compare(QUERIES[name](spark, FOLDER), oracle_connection(FOLDER), ORACLE[name]) is None


def test_op1(spark, texts):
    rows = result(spark, "op1_bootstrapped_pii")
    assert len(rows) == len(texts)
    for row in rows:
        base = pii.base_spans(texts[row.doc_id])
        assert hashlib.sha256(pii.joined(base).encode()).hexdigest() == row.base_sha256
        assert set(pii.joined(base).split(",")) - {""} <= set(row.spans.split(","))
        assert (row.n_email, row.n_ip, row.n_card, row.n_phone) == tuple(sum(k == i for _, k, _ in base) for i in range(4))


def test_op4(spark, texts):
    rows = {row.doc_id: row for row in result(spark, "op4_license_scan")}
    lines = {"MIT": "mit", "GNU General": "gpl-3.0", "Apache": "apache-2.0", "BY-NC": "cc-by-nc-4.0"}
    for i, text in texts.items():
        found = [family for words, family in lines.items() if re.search(f"(License|CC).*{words}|{words}.*License", text)]
        assert (rows[i].family in found) if found else rows[i].family is None, (i, found, rows[i])


def test_op5(spark, texts):
    import numpy as np
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    pieces, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for row in result(spark, "op5_hilbert_packing"):
        pieces[row.doc_id].append(row)
        sequences[row.sequence_id].append(row)
    for i, text in texts.items():
        ids, at = np.array(tokenizer.encode(text, add_special_tokens=False).ids + [2], "<u4"), 0
        for row in sorted(pieces[i], key=lambda row: row.start):
            assert (row.start, row.doc_tokens) == (at, len(ids))
            assert zlib.crc32(ids[at : at + row.length].tobytes()) == row.ids_crc32
            at += row.length
        assert at == len(ids)
    filled = []
    for rows in sequences.values():
        at = 0
        for row in sorted(rows, key=lambda row: row.offset):
            assert row.offset == at
            at += row.length
        filled.append(at)
    assert sorted(filled)[1:] == [4096] * (len(filled) - 1)


def test_op6(spark, texts):
    words = {i: re.findall(r"[^\x20\x09-\x0D]+", lower(t)) + [None] for i, t in texts.items()}
    counts = collections.Counter(w for i, ws in words.items() if zlib.crc32(str(i).encode()) % 7 != 2 for w in ws)
    n, v = sum(counts.values()), len(counts)
    for row in result(spark, "op6_context_tree_score"):
        own = words[row.doc_id]
        assert row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 7 == 2)
        assert (row.n_tokens, row.n_known, row.train_tokens) == (len(own), sum(counts[w] > 0 for w in own), n)
        assert row.base_score == pytest.approx(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in own))
        assert row.score < 0


def test_op7(spark, texts):
    from semlayer.llm.token_counts import pre_tokens, vocabulary

    scores = vocabulary(tokenizer_path("piece_bpe_32k.model"))
    longest, worst = max(map(len, scores)), -math.log(len(scores) + 2) - 10.0

    def brute(word):
        best = [(0.0, 0)]
        for end in range(1, len(word) + 1):
            n = len(word[end - 1].encode())
            options = [(best[end - 1][0] + n * worst, best[end - 1][1] - n)]
            for start in range(max(0, end - longest), end):
                if word[start:end] in scores:
                    options.append((best[start][0] + scores[word[start:end]], best[start][1] - 1))
            best.append(max(options))
        return -best[-1][1]

    for row in result(spark, "op7_trie_token_counts")[:60]:
        own = pre_tokens(texts[row.doc_id])
        assert (row.n_pre_tokens, row.n_tokens) == (len(own), sum(map(brute, own)))


def test_op8(spark, texts):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = collections.defaultdict(set)
    for item in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect():
        own = word.findall(lower(item.text))
        size = min(10, len(own))
        for k in range(len(own) - size + 1 if size else 0):
            windows[tuple(own[k : k + size])].add(item.item_id)
    for row in result(spark, "op8_decontamination"):
        own, hit, items = word.findall(lower(texts[row.doc_id])), set(), set()
        for size in {len(w) for w in windows}:
            for k in range(len(own) - size + 1):
                if (window := tuple(own[k : k + size])) in windows:
                    hit.update(range(k, k + size))
                    items |= windows[window]
        digest = hashlib.sha256(",".join(sorted(map(str, items))).encode()).hexdigest()
        assert tuple(row) == (row.doc_id, len(own), len(hit), len(items), digest, bool(hit))


def test_op9(spark):
    folder = "/root/testdata/sf0.01"
    labels = {row.doc_id: row.toxic for row in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = QUERIES["op9_kneser_ney_toxicity"](spark, folder).collect()
    held = [row for row in rows if row.held_out and row.doc_id in labels]
    assert all(0 <= row.score <= 1 and row.predicted == (row.score >= 0.5) for row in rows)
    assert sum(row.predicted == labels[row.doc_id] for row in held) >= 0.93 * len(held)


def test_op10(spark, texts):
    order = sorted(texts, reverse=True)
    rows = {row.doc_id: row for row in result(spark, "op10_merkle_fingerprint")}
    for k, i in enumerate(order):
        text, following = texts[i], texts[order[(k + 1) % len(order)]]
        n = len(text) // 3
        edited = text[: len(text) - n] + following[:n]
        assert (rows[i].n_chars, rows[i].edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert (rows[i].fingerprint == rows[i].edited_fingerprint) == (text == edited)
    assert sum(row.near_edited > row.near_next for row in rows.values()) > 0.9 * len(rows)


def test_pipeline(spark, texts):
    import corpus_pipeline

    packed = corpus_pipeline.run(spark, FOLDER)
    kept = {row.doc_id for row in packed.select("doc_id").distinct().collect()}
    assert kept < set(texts) and len(kept) > len(texts) // 2
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, FOLDER).columns == docs.columns
