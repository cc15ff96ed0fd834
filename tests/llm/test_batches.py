"""Parts of batches: bounded, whole, and read right by the kernels used on them."""

import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers

from tripflow.llm.batches import large_text, slices
from tripflow.llm.language import words_of
from tripflow.llm.near_dedup import _hashed_words, _shingles
from tripflow.llm.packing import WordTokens

TEXTS = [f"Été {i} WÖRTER straße\tnïño\n{'x' * (i % 7)} 漢字 " * (1 + i % 3) for i in range(40)] + [None, "", "Ä"]


def parts(most):
    batch = pa.record_batch({"id": pa.array(range(len(TEXTS))), "text": pa.array(TEXTS)})
    return list(slices(batch, 1, most))


def test_slices_are_bounded_and_keep_every_row():
    cut = parts(200)
    assert [i for p in cut for i in p.column(0).to_pylist()] == list(range(len(TEXTS)))
    assert all(p.num_rows == 1 or sum(len((t or "").encode()) for t in p.column(1).to_pylist()) <= 200 for p in cut)
    assert len(cut) > 20 and len(parts(1 << 20)) == 1


def test_kernels_on_slices_equal_those_on_single_texts():
    tokens = WordTokens(public_tokenizers.path("word_bpe_49k.json"))
    seen = 0
    for part in parts(400):
        texts = large_text(part.column(1))
        plain = [t or "" for t in part.column(1).to_pylist()]
        assert pc.ascii_lower(texts).to_pylist() == ["".join(c.lower() if c.isascii() else c for c in t) for t in plain]
        ids, at = tokens.documents(part.column(1))
        hashed, starts = _hashed_words(texts)
        shingles, marks = _shingles(hashed, starts, 5)
        first, words, index = words_of(texts)
        for i, text in enumerate(plain):
            alone = large_text(pa.array([text]))
            own_ids, _ = WordTokens.documents(tokens, pa.array([text]))
            assert ids[at[i] : at[i + 1]].tolist() == own_ids.tolist()
            own, own_starts = _hashed_words(alone)
            assert hashed[starts[i] : starts[i + 1]].tolist() == own.tolist()
            assert shingles[marks[i] : marks[i + 1]].tolist() == _shingles(own, own_starts, 5)[0].tolist()
            _, names, where = words_of(alone)
            mine = [words[k] for k in index[first[i] : first[i + 1]]]
            assert mine == [names[k] for k in where]
            seen += 1
    assert seen == len(TEXTS)
