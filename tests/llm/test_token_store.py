import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from stormlens.llm import queries, token_store
from stormlens.llm.arrays import utf8
from stormlens.llm.storage import scratch_path

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", None, " ", "  two  spaces ", "tab\tnewline\n\nend\n", "it's we'll 'twas ' s", "a<|endoftext|>b <|endoftext|> c", "é ñ 漢字  x　y",
       "nul\0byte here", "x" * 5000, "word " * 3000 + "z", "\U0001f600 \U0001f600‍ emoji", "a \x1c b\x85 c", " leading", "trailing\n", "1 22 333 a1b2"]


def want(texts):
    t = Tokenizer.from_file(PATH)
    return [t.encode(x or "", add_special_tokens=False).ids + [token_store.END] for x in texts]


def ids_of(encoder, texts):
    data, offsets = utf8(pa.array(texts, pa.string()))
    ids, bounds = encoder.encode(data, offsets, token_store.END)
    return [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])]


EDGES = ["it's, he's. They're", "a_b, c_. d", "x.y .z ,w", "one.\nTwo,\nthree", "3.14, 2.5. 7,", "αβγ, δ. abcδ. ²x. x².", "é́. a\u0301, b",
         "a.\u00a0b c", "end..", "and&&& then### it!! 'tis' 's. x'.", "\0a b.", "×. ÷, a× b÷.", "Größe. été, ÿ\nß", "a \n b", "\n\na\n\n", "x\u2019. y\u2014, z",
         "a <b |c <|d", "\u3000a b\u2003 c", "don't!won't", "¿qué? ¡no!"]


def test_chunks_give_the_ids_of_whole_texts(prose):
    texts = ODD + EDGES + [prose(k) + "." for k in range(5)]
    encoder = token_store.Encoder(PATH)
    for _ in range(2):
        assert ids_of(encoder, texts) == want(texts)
    assert ids_of(encoder, []) == [] and ids_of(encoder, [None, ""]) == [[token_store.END]] * 2


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("aZé×ñ7 .,'!_\n\t<|\u00a0\u0301漢\u2019"), max_size=30), max_size=4))
def test_any_text_gives_the_ids_of_the_whole_text(texts):
    assert ids_of(token_store.encoder(PATH), texts) == want(texts)


def test_a_small_memory_changes_nothing(prose, monkeypatch):
    monkeypatch.setattr(token_store, "MOST_IDS", 50)
    texts = [prose(k) + ". " + prose(k + 1, 9) + ", x" for k in range(5)]
    encoder = token_store.Encoder(PATH)
    for t in texts:
        assert ids_of(encoder, [t]) == want([t])


def test_files_round_trip_in_order_and_prune_by_id(spark, documents):
    rows = [(1000 - k, t) for k, t in enumerate(ODD)] + [(5, "same"), (5, "same"), (5, "other"), (None, "no id")]
    path = scratch_path(spark, "tokens-test")
    token_store.write_tokens(documents(rows), path, PATH, files=3)
    back = token_store.read_tokens(spark, path).orderBy("part", "pos").collect()
    ids = [r.id for r in back]
    assert ids == sorted(ids, key=lambda x: (x is not None, x)) and len(ids) == len(rows)
    assert sorted((r.id or -1, r.ids) for r in back) == sorted((i or -1, x) for (i, _), x in zip(rows, want([t for _, t in rows])))
    start = 0
    table = {}
    for r in back:
        table.setdefault(r.id, []).append((start, len(r.ids), zlib.crc32(np.array(r.ids, "<u4").tobytes())))
        start += r.n_tokens
    got = {}
    for r in token_store.digest(spark, path).collect():
        got.setdefault(r.doc_id, []).append((r.start, r.n_tokens, r.ids_crc32))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in table.items()}
    part = token_store.read_tokens(spark, path, 990, 995)
    assert sorted(r.id for r in part.collect()) == list(range(990, 996))
    assert "PushedFilters: [IsNotNull(id), GreaterThanOrEqual(id,990), LessThanOrEqual(id,995)]" in part._jdf.queryExecution().toString()


def test_no_documents(spark, documents):
    path = scratch_path(spark, "tokens-test")
    token_store.write_tokens(documents([]), path, PATH)
    assert token_store.digest(spark, path).count() == 0


def test_query_equals_the_tokenizer(spark, sf):
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect())
    start, expected = 0, []
    for (i, _), ids in zip(docs, want([t for _, t in docs])):
        expected.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = queries.QUERIES["op2_token_orc"](spark, sf)
    assert sorted(map(tuple, got.select("doc_id", "start", "n_tokens", "ids_crc32").collect())) == expected
