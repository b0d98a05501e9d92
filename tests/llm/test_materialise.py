import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import materialise as m
from millrace.llm.queries import TOKENIZER
from millrace.llm.tokens import token_ids
from millrace.session import scratch_dir


@pytest.mark.parametrize("count", [1, 2, 3, 5, 16, 17, 1000, 4097])
def test_permutation(count):
    order = m.Feistel(count, 11)
    slots = order.slot(np.arange(count))
    assert sorted(slots) == list(range(count)) and order.number(slots).tolist() == list(range(count))
    if count > 100:
        assert abs(np.corrcoef(np.arange(count), slots)[0, 1]) < 0.15
        assert (m.Feistel(count, 12).slot(np.arange(count)) != slots).mean() > 0.9


def test_shards(spark, text_of, tmp_path):
    docs = [(i, None if i == 3 else text_of(i, 11 * i)) for i in range(60)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    folder = scratch_dir(spark, "shards")
    manifest = m.materialise(df, folder, TOKENIZER, seed=5, stride=64, shard_slots=10)
    tokens = token_ids(TOKENIZER)
    rows = m.read_slots(manifest, folder, tokens.dtype, 64, 10).collect()
    assert sorted(r.slot for r in rows) == list(range(len(rows))) and all(r.shard == r.slot // 10 for r in rows)
    order = m.Feistel(len(rows), 5)
    assert all(order.number(np.array([r.slot]))[0] == r.sequence for r in rows)
    stream = np.concatenate([np.frombuffer(r.ids, "<u2") for r in sorted(rows, key=lambda r: r.sequence)])
    want = [np.append(np.frombuffer(x, "<u2"), 2).tolist() for x in tokens.encode(t for _, t in docs)]
    assert len(stream) == sum(map(len, want))
    cut = [x.tolist() for x in np.split(stream, np.flatnonzero(stream == 2) + 1)][:-1]
    assert sorted(cut) == sorted(want)
    later = m.read_slots(manifest, folder, tokens.dtype, 64, 10, from_slot=25)
    assert {r.slot for r in later.collect()} == set(range(25, len(rows)))
    fs, root = m._place(folder)
    sizes = {x.base_name: x.size for x in fs.get_file_info(m.pafs.FileSelector(root))}
    assert sizes == {m.shard_name(s): 128 * min(10, len(rows) - 10 * s) for s in range(-(-len(rows) // 10))}


def test_odd_documents(spark, odd_docs, no_docs):
    folder = scratch_dir(spark, "shards")
    manifest = m.materialise(odd_docs, folder, TOKENIZER)
    total = manifest.agg(F.sum("n_tokens")).first()[0]
    assert total == sum(len(x) // 2 + 1 for x in token_ids(TOKENIZER).encode(r.text for r in odd_docs.collect()))
    empty = scratch_dir(spark, "shards")
    assert m.read_slots(m.materialise(no_docs, empty, TOKENIZER), empty, np.dtype("<u2")).count() == 0
