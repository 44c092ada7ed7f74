import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from voxtile.llm import gru, lm
from voxtile.llm.common import gathered, words_of

ODD = ["", None, " ", "a", " A\x0bb\x0c\r\n c\t", "é É  x\x1c\x1f\x85y", "\n", "abc ab a", "ÄB İ K \x00 z", "漢字 かな"]


def test_words_of_whole_blocks():
    """Splitting and numbering whole blocks gives what single texts give, whatever slice of a batch they are."""
    v = gru.Vocabulary([b"a", b"b", b"ab"], [3, 2, 1])
    for texts, column in ((ODD, pa.array(ODD)), (ODD[3:8], pa.array(ODD).slice(3, 5)), ([], pa.array([], pa.string()))):
        want = [lm.tokens((x or "").encode()) for x in texts]
        words, length = words_of(pc.ascii_lower(column))
        assert length.tolist() == [len(x) for x in want]
        assert words.to_pylist() == [w for x in want for w in x]
        assert v.numbers(words).tolist() == v.ids(words.to_pylist(), {})


def test_batches_are_put_together():
    batch = pa.RecordBatch.from_arrays([pa.array(["x" * 100] * 5)], ["text"])
    assert [b.num_rows for b in gathered(iter([batch] * 7), "text", 1500)] == [15, 15, 5]


def test_lanes_in_proportion_to_tokens():
    """One long text beside short ones: the arrays don't hold a lane of its length for each of them."""
    documents = [np.ones(50_000, np.int32)] + [np.ones(20, np.int32)] * 500
    inputs, targets, _, of = gru.lanes(documents)
    assert inputs.size < 3 * sum(len(d) + 1 for d in documents)
    assert np.array_equal(np.bincount(of[of >= 0]), [len(d) + 1 for d in documents])


def test_scores_beyond_the_range_of_exp():
    """Large weights: rows are shifted by their largest score, and the shares are those of float64."""
    v = gru.Vocabulary([b"a", b"b", b"c", b"d"], [5, 4, 3, 2])
    p = {k: 40 * a for k, a in gru.initial(v).items()}
    documents = [np.array([1, 2, 3, 4, 5, 1]), np.array([2, 2])]
    whole = gru.log_likelihoods({k: a.astype(np.float64) for k, a in p.items()}, v, documents)
    assert np.isfinite(whole).all() and np.allclose(gru.log_likelihoods(p, v, documents), whole, rtol=1e-3)
