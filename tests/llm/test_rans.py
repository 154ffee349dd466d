from __future__ import annotations

import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from reviewloom.llm import files, rans, wordids
from reviewloom.staging import fresh_path

PATH = wordids.vocabulary("word_bpe_49k.json")


def whole_text_ids(text: str | None) -> list[int]:
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(PATH)
    return library.encode(text or "", add_special_tokens=False).ids + [2]


def test_files_give_back_the_ids(awkward, awkward_rows):
    got = sorted(rans.token_files(awkward, PATH).collect(), key=lambda r: r["start"])
    ids = [r["doc_id"] for r in got]
    assert len(got) == len(awkward_rows) and ids[:2] == [None, None] and ids[2:] == sorted(ids[2:])
    want, start = {}, 0
    for i, text, *_ in awkward_rows:
        raw = np.array(whole_text_ids(text), "<u4")
        want.setdefault(i, []).append((len(raw), zlib.crc32(raw.tobytes())))
    for row in got:
        assert row["start"] == start
        start += row["n_tokens"]
        want[row["doc_id"]].remove((row["n_tokens"], row["ids_crc32"]))
    assert not any(want.values())


def test_empty_table(nothing):
    assert rans.token_files(nothing, PATH).collect() == []


def test_a_damaged_block_is_noticed(spark, awkward):
    folder = fresh_path(spark, "tokens")
    rans.write_tokens(awkward.where("doc_id between 300 and 305 or doc_id is null"), PATH, 2, folder, 49_408)
    places, table = rans.open_tokens(spark, folder)
    place, coder = places.orderBy("part", "block").first(), rans.Coder(table)
    raw = files.Reader().read(place["path"], place["offset"], place["length"])
    rans.unpack_block(coder, raw)
    for at in range(len(raw)):
        bad = bytearray(raw)
        bad[at] ^= 1 << (at % 8)
        with pytest.raises(ValueError, match="checksum"):
            rans.unpack_block(coder, bytes(bad))
    with pytest.raises(ValueError, match="checksum"):
        rans.unpack_block(coder, raw[:-1])


def test_a_folder_can_be_opened_later(spark, awkward):
    folder = fresh_path(spark, "tokens")
    rans.write_tokens(awkward, PATH, 2, folder, 49_408)
    places, table = rans.open_tokens(spark, folder)
    assert table.sum() == 1 << rans.BITS
    one = places.orderBy("part", "block").limit(1)
    first = rans.read_tokens(one, table).orderBy("start").first()
    assert (first["start"], first["doc_id"]) == (0, None)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 40), max_size=3000), st.integers(1, 600))
def test_coder_round_trip(ids, lanes):
    ids = np.array(ids, np.int64)
    coder = rans.Coder(rans.frequency_table(np.bincount(ids, minlength=41)))
    states, words = coder.encode(ids, lanes)
    assert (coder.decode(len(ids), states, words) == ids).all()


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_words_encode_as_the_whole_text(text):
    from reviewloom.llm.common import hash_spans, word_spans

    data = np.frombuffer(text.encode(errors="ignore"), np.uint8)
    text = data.tobytes().decode()
    starts, ends, _ = word_spans(data, np.array([0, len(data)]))
    ids, _ = wordids.word_pairs(PATH).lookup(data, starts, ends, hash_spans(data, starts, ends))
    assert ids.tolist() + [2] == whole_text_ids(text)
