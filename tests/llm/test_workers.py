"""What travels to the executors needs no package there."""

import os
import subprocess
import sys

import numpy as np
import pytest
from pyspark import cloudpickle

from pressloom.llm import chunked_bpe, main_text, near_duplicates, packing, personal_data, quality_classifier, ranked_search, simhash, tokenizer_files, vector_codes, warc

CASES = [
    (simhash.fingerprint, ("a b c d e f",)),
    (simhash.parts, None),
    (quality_classifier.vector, ("some words",)),
    (personal_data.all_spans, None),
    (main_text.label, None),
    (warc._derivatives, None),
    (tokenizer_files.encode, ("some words",)),
    (tokenizer_files.token_bytes, ()),
    (chunked_bpe._reader(None, tokenizer_files.BPE_RANKS, True), None),
    (chunked_bpe._encoder(tokenizer_files.BPE_RANKS), None),
    (chunked_bpe._assembler(tokenizer_files.BPE_RANKS), None),
    (near_duplicates.shingles, ("a b c d e f",)),
    (vector_codes.nearest, (np.array([[3, 4]]), np.array([[0, 0], [4, 4]]))),
    (ranked_search.Block([(1, {"a": 1})]).counts, ("a b a",)),
    (packing.encoded, ([b"some words, and more", None],)),
    (packing.packed, None),
]


@pytest.mark.parametrize("function,given", CASES)
def test_worker_functions_need_no_package(function, given, tmp_path):
    (tmp_path / "job").write_bytes(cloudpickle.dumps((function, given)))
    code = "import sys, pickle; f, x = pickle.load(open('job', 'rb')); x is None or f(*x); assert 'pressloom' not in sys.modules; print('done')"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=60)
    assert done.stdout.strip() == "done", done.stderr
