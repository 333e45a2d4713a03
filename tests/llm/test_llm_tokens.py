"""Token files and packing, held against the tokenizer itself."""

import os
from types import SimpleNamespace

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from brute import crc, pieces, tokens
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_helpers import DOCS, REPEATED, SF, documents, got, tokenizer, want  # noqa: F401

from twinrun.llm import kernels, token_files
from twinrun.llm.kernels import Encoder
from twinrun.llm.packing import pack
from twinrun.llm.queries import op4_packing, op5_token_files
from twinrun.llm.token_files import read_tokens, token_index, write_tokens
from twinrun.llm.tokenizer import tokenizer_path


def starts(docs, tokenizer):  # noqa: F811
    out, at = [], 0
    for d, t in docs:
        ids = tokens(t, tokenizer, 2)
        out.append((d, at, len(ids), crc(ids)))
        at += len(ids)
    return out


def test_token_files_whole_table(spark, tokenizer):  # noqa: F811
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    assert got(op5_token_files(spark, SF), "doc_id", "start", "n_tokens", "ids_crc32") == want(starts(docs, tokenizer))


def test_token_files_edges(spark, tokenizer):  # noqa: F811
    docs = [r for r in DOCS if r[0] is not None]
    out = token_index(spark, write_tokens(documents(spark, docs), tokenizer_path()))
    assert got(out, "doc_id", "start", "n_tokens", "ids_crc32") == want(starts(docs, tokenizer))
    path = write_tokens(documents(spark, REPEATED), tokenizer_path())
    rows = read_tokens(spark, path)
    assert rows.count() == len(REPEATED)
    assert got(rows.filter("doc_id = 4"), "tokens") == want([(tokens("one two three", tokenizer, 2),)] * 3)
    index = [tuple(r) for r in token_index(spark, path).select("start", "n_tokens").orderBy("start").collect()]
    assert all(a + n == b for (a, n), (b, _) in zip(index, index[1:]))
    assert read_tokens(spark, path).filter("doc_id is null").count() == 3


def test_token_files_are_in_order_and_empty_table_works(spark):
    path = write_tokens(documents(spark, [(i % 50, f"t{i}") for i in range(200)]), tokenizer_path())
    ids = [r.doc_id for r in read_tokens(spark, path).orderBy("part", "pos").collect()]
    assert ids == sorted(ids)
    assert token_index(spark, write_tokens(documents(spark, []), tokenizer_path())).count() == 0


def test_token_files_encode_many_texts_at_once(monkeypatch, tokenizer):  # noqa: F811
    """A step hashes the table of earlier chunks anew: token files take more text in one."""
    monkeypatch.setattr(kernels, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 3)))
    monkeypatch.setattr(kernels, "worker_encoder", lambda path: Encoder(path))
    texts = [f"w{i} " + "one two " * 125_000 for i in range(5)] + [None, ""]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(7)), "text": texts})
    few, many = (list(kernels.encode_rows(iter([batch]), tokenizer_path(), 2, *size))
                 for size in ((token_files.STEP_BYTES,), ()))
    assert len(few) == 1 < len(many)
    assert pa.Table.from_batches(few).combine_chunks() == pa.Table.from_batches(many).combine_chunks()
    assert few[0].column("tokens")[0].as_py() == tokens(texts[0], tokenizer, 2)


def check_pieces(out, docs, tokenizer):  # noqa: F811
    cols = ("doc_id", "start", "length", "ids_crc32", "doc_tokens")
    assert got(out, *cols) == want((d, *p) for d, t in docs for p in pieces(t, tokenizer))
    rows = out.collect()
    assert sorted(r.sequence_id for r in rows) == list(range(len(rows)))
    assert all(r.offset == 0 and r.length <= 2048 and r.length & (r.length - 1) == 0 for r in rows)
    by_id = [r.length for r in sorted(rows, key=lambda r: r.sequence_id)]
    assert by_id == sorted(by_id, reverse=True)


def test_packing_whole_table(spark, tokenizer):  # noqa: F811
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    check_pieces(op4_packing(spark, SF), docs, tokenizer)


def test_packing_edges(spark, tokenizer):  # noqa: F811
    check_pieces(pack(documents(spark, REPEATED), tokenizer_path(), digest=True), REPEATED, tokenizer)
    assert pack(documents(spark, []), tokenizer_path(), digest=True).count() == 0


def test_pieces_carry_their_ids(spark, tokenizer):  # noqa: F811
    rows = pack(documents(spark, DOCS), tokenizer_path()).filter("doc_id = 16").orderBy("start").collect()
    assert sum((r.tokens for r in rows), []) == tokens("x " * 5000, tokenizer, 1)


SPECIAL = st.lists(st.sampled_from(["<|endoftext|>", "<|endoftext", "|>", " ", "  ", "\n", "a", " word", "'s", "é", "　", "1", "."]), max_size=30).map("".join)


@pytest.mark.parametrize("remembered", [0, 3, 1000])
@given(st.lists(st.text(alphabet=list("ab'é　\x85\x1c \n\t.<|>1日😀"), max_size=40) | SPECIAL, max_size=8))
@settings(max_examples=60, deadline=None)
def test_encoder_equals_untouched_tokenizer(remembered, texts):
    from tokenizers import Tokenizer
    plain = Tokenizer.from_file(tokenizer_path())
    e = Encoder(tokenizer_path(), remembered)
    for _ in range(2):
        off, ids = e.encode(pa.array(texts, pa.string()))
        assert [ids[a:b].tolist() for a, b in zip(off[:-1], off[1:])] == [
            plain.encode(t, add_special_tokens=False).ids for t in texts]


def test_special_string_is_its_own_id(tokenizer):  # noqa: F811
    assert 50256 in tokens("a <|endoftext|> b", tokenizer, 2)
    assert sum(50256 in tokens(t, tokenizer, 2) for _, t in DOCS) == 1


def test_token_files_format(spark):
    """Dictionary ids, delta-coded numbers, small row groups, column and offset indexes."""
    rows = [(i, f"text {i} " + "some more words " * (i % 40)) for i in range(3000)]
    path = write_tokens(documents(spark, rows), tokenizer_path())
    root = path.removeprefix("file:")
    files = [os.path.join(d, f) for d, _, names in os.walk(root) for f in names if f.endswith(".parquet")]
    assert files
    for f in files:
        meta = pq.ParquetFile(f).metadata
        for g in range(meta.num_row_groups):
            group = meta.row_group(g)
            for c in range(group.num_columns):
                chunk = group.column(c)
                assert chunk.has_offset_index and chunk.has_column_index, chunk.path_in_schema
                if chunk.path_in_schema.startswith("tokens"):
                    assert {"PLAIN_DICTIONARY", "RLE_DICTIONARY"} & set(chunk.encodings)
                elif chunk.path_in_schema != "part" and chunk.physical_type in ("INT32", "INT64"):  # part: one value a file
                    assert "DELTA_BINARY_PACKED" in chunk.encodings, (chunk.path_in_schema, chunk.encodings)
