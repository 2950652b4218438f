"""The corpus pipeline, stage by stage, against brute force on sf0.001."""

import re
from collections import Counter

import numpy as np
import pytest
import xxhash

import corpus_pipeline
from changelake.llm import queries

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Output of every stage, each stored and read again as the next one's input."""
    root = tmp_path_factory.mktemp("stages")
    out = [spark.read.parquet(f"{SF}/documents.parquet")]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, out[-1], SF).write.parquet(str(root / f"{k}"))
        out.append(spark.read.parquet(str(root / f"{k}")))
    return out


def _fp(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))
    if not words:
        return 0
    grams = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    bits = sum(((np.uint64(xxhash.xxh64_intdigest(g.encode(), 42)) >> np.arange(64, dtype=np.uint64)) & np.uint64(1)).astype(int)
               for g in grams)
    return sum(1 << i for i in range(64) if 2 * bits[i] > len(grams))


def test_names_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash", "pii", "mixing", "packing"]
    for df in stages[1:-1]:
        assert df.schema.simpleString() == stages[0].schema.simpleString()


def test_toxic_documents_go_and_clean_ones_stay(spark, stages):
    before = {r.doc_id for r in stages[0].collect()}
    after = {r.doc_id for r in stages[1].collect()}
    toxic = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").where("toxic = 1").collect()}
    clean = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").where("toxic = 0").collect()}
    assert after <= before and len((before - after) & clean) <= 0.02 * len(clean)
    assert len(before - after) > 0.3 * len(toxic)


def test_one_document_of_every_group_stays(stages):
    rows = {r.doc_id: _fp(r.text or "") for r in stages[1].collect()}
    ids, root = sorted(rows), {}
    for i in ids:                                   # smallest id of each component
        root[i] = i

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for a in ids:
        for b in ids:
            if a < b and (rows[a] ^ rows[b]).bit_count() <= 4:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    assert sorted(r.doc_id for r in stages[2].collect()) == sorted({find(i) for i in ids})


def test_personal_data_is_gone_and_other_texts_are_unchanged(stages):
    old = {r.doc_id: r.text for r in stages[2].collect()}
    email = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    for r in stages[3].collect():
        assert not email.search(r.text) and r.n_chars == len(r.text)
        if not re.search(r"[0-9@]", old[r.doc_id]):
            assert r.text == old[r.doc_id]
    assert stages[3].count() == len(old)


def test_mixed_documents_are_whole_and_near_their_targets(stages):
    have = Counter((r.doc_id, r.text) for r in stages[3].collect())
    got = Counter((r.doc_id, r.text) for r in stages[4].collect())
    assert set(got) <= set(have) and max(got.values()) <= 2
    words = sum(len(WORD.findall(t)) for _, t in have.elements())
    mixed = sum(len(WORD.findall(t)) for _, t in got.elements())
    assert 1.4 * words <= mixed <= 1.5 * words


def test_sequences_rebuild_the_mix(spark, stages):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(queries.tokenizer_path())
    want = Counter()
    for r in stages[4].collect():
        want[r.doc_id] += len(tok.encode(r.text, add_special_tokens=False).ids) + 1
    got, room = Counter(), Counter()
    for r in stages[5].collect():
        got[r.doc_id] += r.length
        room[r.sequence_id] += r.length
    assert got == want and max(room.values()) <= 2048
    assert len(room) <= -(-sum(want.values()) // 2048) * 1.02 + 2
    rows = Counter((r.doc_id, r.piece, r.ids_crc32) for r in corpus_pipeline.run(spark, SF).collect())
    assert rows == Counter((r.doc_id, r.piece, r.ids_crc32) for r in stages[5].collect())
