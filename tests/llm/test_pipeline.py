"""The pipeline, stage by stage, against plain definitions on the stage's own input."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from tests.llm import brute
from tests.llm.conftest import MESSY
from tidewell.llm import bpe, mixing, secrets
from tidewell.llm.common import _folder, staged, table
from tidewell.llm.queries import RANKS


@pytest.fixture(scope="module")
def stages(spark, small):
    docs, out = table(spark, small, "documents"), {}
    out["documents"] = docs
    for name, stage in corpus_pipeline.STAGES:
        docs = out[name] = staged(stage(spark, docs, small))
    return out


def rows(df, *names):
    return Counter(tuple(r) for r in df.select(*names).collect())


def test_languages_drop_only_texts_without_letters(stages):
    want = Counter({k: n for k, n in rows(stages["documents"], "doc_id", "text").items() if any(c.isalpha() for c in k[1] or "")})
    assert rows(stages["language_id"], "doc_id", "text") == want
    before = {r.doc_id: r.lang for r in stages["documents"].collect()}
    assert all(r.lang is not None and before[r.doc_id] in (r.lang, None) for r in stages["language_id"].collect())


def test_one_of_each_group_stays(stages):
    before = stages["language_id"].select("doc_id", "text").collect()
    want = brute.near_copies([tuple(r) for r in before])
    assert sorted(r.doc_id for r in stages["near_copies"].collect()) == sorted({i for i, c in want.items() if i == c})


def test_secrets_are_replaced(stages):
    before, after = stages["near_copies"].collect(), {r.doc_id: r for r in stages["secrets"].collect()}
    assert len(before) == len(after)
    for r in before:
        text = brute.redacted(r.text, secrets.BASE + secrets.MORE)
        assert after[r.doc_id].text == text and after[r.doc_id].n_chars == (r.n_chars if text == r.text else len(text))


def test_mixture_repeats_documents(stages):
    plan = mixing.taken(mixing.mix(stages["secrets"])).collect()
    assert {i: n for (i,), n in rows(stages["mixture"], "doc_id").items()} == {r.doc_id: r.copies for r in plan if r.copies}
    for name in ("language_id", "near_copies", "secrets", "mixture"):
        assert stages[name].columns == stages["documents"].columns


def test_tokens_of_each_copy(spark, small, stages):
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(public_tokenizers.path(RANKS)), special_tokens={})
    want = Counter()
    for r in stages["mixture"].collect():
        ids = library.encode_ordinary(r.text)
        want[r.doc_id, len(ids), hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest(), hashlib.sha256(r.text.encode()).hexdigest()] += 1
    assert rows(stages["tokens"], "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == want
    assert rows(corpus_pipeline.run(spark, small), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == want


def test_stages_leave_nothing_but_the_last_rows_behind(spark, small):
    before = set(folders(spark))
    out = corpus_pipeline.run(spark, small)
    made = set(folders(spark)) - before
    assert out.count() > 0
    held = {f.rsplit("/", 1)[0].rsplit("/", 1)[-1] for f in out.inputFiles()}
    assert held <= made and len(made) <= 4  # the last stage's documents, and what that stage has staged for itself


def folders(spark):
    root = spark._jvm.org.apache.hadoop.fs.Path(_folder(spark))
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in fs.listStatus(root)] if fs.exists(root) else []


def test_stages_take_messy_and_empty_tables(spark, small, messy, empty):
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, messy, small)
        assert out.count() <= 3 * len(MESSY) and (name == "tokens" or out.columns == messy.columns)
        assert stage(spark, empty, small).count() == 0
