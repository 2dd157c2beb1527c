import tracemalloc

import pyarrow as pa

from postlode.llm import phrase_index


def test_words_of_a_segment_are_few_python_objects():
    words = phrase_index._Words()
    pa.array([b"x"], pa.binary())  # the first call imports pandas
    tracemalloc.start()
    try:
        for i in range(2000):
            words.add([b"w%d" % (i * 100 + j) for j in range(100)])
        held = tracemalloc.get_traced_memory()[0]
    finally:
        tracemalloc.stop()
    assert len(words) == 200_000
    assert held < 5_000_000  # a list of them holds over 8 MB


def test_words_keep_their_order_and_first_places():
    words = phrase_index._Words()
    expected = []
    for i in range(3000):
        some = [b"w%d" % (j * i % 777) for j in range(60)]
        words.add(some)
        expected += some
    coded = words.coded()
    plain = pa.array(expected, pa.binary()).dictionary_encode()
    assert coded.to_pylist() == expected
    assert coded.dictionary.equals(plain.dictionary) and coded.indices.equals(plain.indices)
