"""The pipeline's rows against plain Python and SQL, stage after stage, over a whole table."""

import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from shoptally.llm import mixing, quality_rules, secrets

SF_DIR = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[i : i + 4]) for i in range(len(w) - 3)) if len(w) >= 4 else frozenset([tuple(w)] if w else [])


def first_of_groups(texts):
    """Ids of which no smaller one is reachable over links of 80 percent."""
    sets = {i: shingles(t) for i, t in texts.items()}
    group = {i: i for i in texts}

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    ids = sorted((i for i in sets if sets[i]), key=lambda i: len(sets[i]))
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if 100 * len(sets[a]) < 80 * len(sets[b]):
                break
            both = len(sets[a] & sets[b])
            if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((top(a), top(b)))
                group[y] = x
    return {i for i in texts if top(i) == i}


def redacted(text, model):
    text = text or ""
    base, values = secrets.base_spans(text)
    free = [(0, a, b) for a, b, hit in secrets.candidates(text, base, values) if not hit]
    spans = sorted([(s.start, s.end) for s in base] + [(a, b) for _, a, b in secrets.model_spans([text], free, model)])
    out, at = "", 0
    for start, end in spans:
        if start >= at:
            out += text[at:start] + "[SECRET]"
        at = max(at, end)
    return out + text[at:]


def test_rows_of_the_whole_pipeline(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF_DIR}/documents.parquet')")
    good = {i for i, kept in con.execute(f"SELECT doc_id, kept FROM ({quality_rules.report_sql()})").fetchall() if kept}
    texts = {r.doc_id: r.text for r in docs.collect() if r.doc_id in good}
    source = {r.doc_id: r.source for r in docs.select("doc_id", "source").collect()}
    kept = first_of_groups(texts)
    assert 0 < len(kept) < len(texts) < docs.count()
    model = secrets.learn(docs.where(docs.doc_id.isin(sorted(kept))))
    clean = {i: redacted(texts[i], model) for i in kept}
    assert any(clean[i] != texts[i] for i in kept)
    mix = duckdb.connect()
    mix.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    mix.executemany("INSERT INTO documents VALUES (?, ?, ?)", [(i, t, source[i]) for i, t in clean.items()])
    repeats = dict(mix.execute(f"SELECT doc_id, repeats FROM ({mixing.report_sql()})").fetchall())
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    wanted = Counter()
    for i, text in clean.items():
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 1], "<u4")
        for k, start in enumerate(range(0, len(ids), 4096)):
            part = ids[start : start + 4096]
            wanted[i, k, start, len(part), zlib.crc32(part.tobytes())] += repeats[i]
    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == +wanted
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 4096
    assert len(sequences) <= 1.02 * sum(r.length for r in rows) / 4096 + 1


def test_the_last_stage_on_odd_rows(spark, odd_docs):
    _, pack = corpus_pipeline.STAGES[-1]
    rows = pack(spark, odd_docs, SF_DIR).collect()
    assert Counter(r.doc_id for r in rows if r.piece == 0) == Counter(r.doc_id for r in odd_docs.collect())
    assert pack(spark, odd_docs.limit(0), SF_DIR).count() == 0
