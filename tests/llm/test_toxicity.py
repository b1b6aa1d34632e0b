import zlib

import pyarrow as pa
from conftest_llm import ODD

from millwright.llm import toxicity

CLEAN = "the river runs past old mills and quiet fields of barley today".split()


def sentence(i, bad):
    words = [CLEAN[(i * 7 + k * (i % 5 + 1)) % len(CLEAN)] for k in range(12)]
    return " ".join([*words[:5], "blasted", "rotter", *words[5:]] if bad else words)


def tables(spark, documents, n=300):
    rows = [(i, sentence(i, i % 4 == 0)) for i in range(n)]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(n)], "doc_id long, toxic int")
    return rows, documents(*rows), labels


def test_held_out_rows_are_told_apart(spark, documents):
    rows, docs, labels = tables(spark, documents)
    got = {r.doc_id: r for r in toxicity.classify(docs, labels).collect()}
    assert len(got) == len(rows)
    for i, _ in rows:
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= got[i].score <= 1 and got[i].predicted == (got[i].score >= 0.5)
    tested = [i for i, _ in rows if got[i].held_out]
    assert sum(got[i].predicted == (i % 4 == 0) for i in tested) >= 0.95 * len(tested)


def test_held_out_labels_teach_nothing(spark, documents):
    _, docs, labels = tables(spark, documents)
    wrong = labels.selectExpr("doc_id", "int(if(crc32(string(doc_id)) % 5 = 0, 1 - toxic, toxic)) as toxic")
    a, b = (sorted(map(str, toxicity.classify(docs, x).collect())) for x in (labels, wrong))
    assert a == b


def test_odd_rows_and_missing_labels(spark, documents):
    labels = spark.createDataFrame([(1, 1), (None, 1), (3, None), (4, 0), (4, 0), (9, 1)], "doc_id long, toxic int")
    got = toxicity.classify(documents(*ODD), labels).collect()
    assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got)
    none = toxicity.classify(documents(*ODD), labels.where("false")).collect()
    assert all(r.predicted == 0 for r in none)
    assert toxicity.classify(documents(), labels).collect() == []


def test_features_do_not_cross_texts():
    row, index = toxicity.features(pa.array(["one two three", None, "", "one"]), 20, (1, 2))
    assert [sum(row == i) for i in range(4)] == [6, 0, 0, 1]
    alone = toxicity.features(pa.array(["one"]), 20, (1, 2))[1]
    assert index[row == 3].tolist() == alone.tolist()


def test_words_lose_case_and_outer_punctuation():
    a = toxicity.features(pa.array(["Rotter, you!"]), 20, (1,))[1]
    b = toxicity.features(pa.array(["(rotter) you"]), 20, (1,))[1]
    assert a.tolist() == b.tolist()


def test_long_texts_are_scored_whole():
    model = toxicity.Model(20, (1,), -5.0, *_weight_of("rotter", 20.0))
    text = "fine " * 100_000
    assert toxicity.scores(pa.array([text, text + "rotter"]), model).round().tolist() == [0, 1]


def test_a_toxic_group_of_copies_is_learnt(spark, documents):
    copy = "one same message that was sent to every list there is"
    rows = [(i, copy if i % 3 == 0 else sentence(i, False)) for i in range(300)] + [(300, "")]
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(300)], "doc_id long, toxic int")
    got = {r.doc_id: r.predicted for r in toxicity.classify(documents(*rows), labels).collect()}
    assert [got[i] for i in range(300)] == [int(i % 3 == 0) for i in range(300)]
    assert got[300] == 0


def _weight_of(word, weight):
    import numpy as np

    return toxicity.features(pa.array([word]), 20, (1,))[1], np.array([weight])


def plain_ftrl(rows, s):
    """The same model by dicts and loops: {coordinate: weight}, bias."""
    import math
    from collections import Counter

    import xxhash

    texts = {i: sorted(set(toxicity.features(pa.array([t]), s.bits, s.skips)[1].tolist())) for i, t, _ in rows}
    often = {f for f, n in Counter(f for x in texts.values() for f in x).items() if n >= s.rare}
    label = {i: y for i, _, y in rows}
    shards = [[i for i in texts if xxhash.xxh64_intdigest(str(i)) % s.shards == k] for k in range(s.shards)]
    for ids in shards:
        ids.sort(key=lambda i: (xxhash.xxh64_intdigest(str(i), 1), i))
    toxic = sum(label.values())
    state = {"bias": (-math.log(toxic / (len(rows) - toxic)) * (s.beta + 1) / s.alpha, 1.0)}

    def weight(name, z, n):
        if name == "bias":
            return -z / ((s.beta + math.sqrt(n)) / s.alpha)
        return 0.0 if abs(z) <= s.l1 else -math.copysign(abs(z) - s.l1, z) / ((s.beta + math.sqrt(n)) / s.alpha + s.l2)

    for _ in range(min(max(-(-s.visits // len(rows)), s.rounds[0]), s.rounds[1])):
        ends = []
        for ids in shards:
            own = dict(state)
            for i in ids:
                names = ["bias", *[f for f in texts[i] if f in often]]
                ws = {f: weight(f, *own.get(f, (0.0, 0.0))) for f in names}
                g = 1 / (1 + math.exp(-max(-35, min(35, sum(ws.values()))))) - label[i]
                for f in names:
                    z, n = own.get(f, (0.0, 0.0))
                    own[f] = (z + g - (math.sqrt(n + g * g) - math.sqrt(n)) / s.alpha * ws[f], n + g * g)
            ends.append((len(ids), own))
        state = {
            f: tuple(sum(k * own.get(f, (0.0, 0.0))[j] for k, own in ends) / len(rows) for j in (0, 1))
            for f in {f for _, own in ends for f in own}
        }
    weights = {f: weight(f, *v) for f, v in state.items()}
    bias = weights.pop("bias")
    return {f: w for f, w in weights.items() if w}, bias


def test_weights_are_those_of_a_plain_ftrl(spark, documents):
    rows = [(i, sentence(i, i % 4 == 0), int(i % 4 == 0)) for i in range(80)]
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    s = toxicity.Settings(rounds=(3, 3), l1=0.5)
    model = toxicity.train(documents(*[r[:2] for r in rows]), labels, s)
    weights, bias = plain_ftrl(rows, s)
    got = dict(zip(model.index.tolist(), model.weight.tolist()))
    assert got.keys() == weights.keys() and len(got) > 5
    assert all(abs(got[f] - w) < 1e-9 for f, w in weights.items()) and abs(model.bias - bias) < 1e-9


def test_clashing_columns_of_labels(spark, documents):
    _, docs, labels = tables(spark, documents, 40)
    wide = labels.selectExpr("doc_id", "'x' AS DOC_ID", "toxic", "9 AS Toxic", "1 AS text")
    a, b = (sorted(map(str, toxicity.classify(docs, x).collect())) for x in (labels, wide))
    assert a == b


def test_held_out_quality_on_a_given_table(spark):
    folder = "/root/testdata/sf0.1"  # smaller ones hold out a handful of toxic documents only
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    got = toxicity.classify(spark.read.parquet(f"{folder}/documents.parquet"), labels)
    held = got.where("held_out").join(labels, "doc_id").select("predicted", "toxic").collect()
    assert len(held) > 500 and sum(r.toxic for r in held) > 30
    assert sum(r.predicted == r.toxic for r in held) >= 0.97 * len(held)
    assert sum(r.predicted for r in held if r.toxic) >= 0.75 * sum(r.toxic for r in held)


def test_coordinates_of_a_batch_are_those_of_each_text():
    import pyarrow.compute as pc

    s = toxicity.Settings()
    texts = pa.array(["a b a b c", "", None, "d", "a " * 1000])
    lists = toxicity.coordinates(texts, s).to_pylist()
    for text, got in zip(texts, lists):
        assert got == sorted(set(toxicity.features(pa.array([text.as_py()], pa.string()), s.bits, s.skips)[1].tolist()))
    assert pc.sum(pc.list_value_length(toxicity.coordinates(texts, s))).as_py() == sum(map(len, lists))


def test_a_round_holds_one_batch_of_its_shard_at_a_time():
    import weakref
    from types import SimpleNamespace

    import numpy as np

    def batches():
        for _ in range(12):
            alive.append(sum(x() is not None for x in made))
            values = np.zeros(100, np.int32)
            made.append(weakref.ref(values))
            lists = pa.ListArray.from_arrays(pa.array([0, 50, 100], pa.int32()), pa.array(values))
            doc_id, toxic = pa.array([1, 2], pa.int64()), pa.array([0, 1], pa.int32())
            batch = pa.RecordBatch.from_arrays([doc_id, toxic, lists], names=["doc_id", "toxic", "index"])
            del values, lists
            yield batch
            del batch

    made, alive = [], []
    state = SimpleNamespace(value=(np.zeros(3), np.ones(3)))
    assert len(list(toxicity._learner(state, toxicity.Settings())(batches()))) == 1
    assert len(made) == 12 and max(alive) <= 2


def test_training_texts_pass_one_python_process_a_task(spark, documents, monkeypatch):
    plans = []
    write = type(documents().write).parquet

    def noted(self, path, *a, **b):
        plans.append(self._df._jdf.queryExecution().optimizedPlan().toString())
        return write(self, path, *a, **b)

    monkeypatch.setattr(type(documents().write), "parquet", noted)
    _, docs, labels = tables(spark, documents, 40)
    toxicity.train(docs, labels)
    assert [p.count("MapInArrow") for p in plans if "MapInArrow" in p] == [1]


def test_states_of_the_rounds_do_not_reach_the_driver(spark, documents, monkeypatch):
    _, docs, labels = tables(spark, documents, 200)
    kind, got, sent = type(docs), [], []
    to_arrow, broadcast = kind.toArrow, type(spark.sparkContext).broadcast
    monkeypatch.setattr(kind, "toArrow", lambda self: got.append(to_arrow(self)) or got[-1])
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda self, x: sent.append(x) or broadcast(self, x))
    model = toxicity.train(docs, labels, toxicity.Settings(l1=0.5))
    assert [x.column_names for x in got] == [["i"], ["at", "weight"]] and len(sent) == 1
    assert 0 < len(model.index) == got[1].num_rows - 1 < got[0].num_rows


def test_stored_states_are_averaged_over_blocks_and_batches(monkeypatch):
    import numpy as np

    monkeypatch.setattr(toxicity, "BLOCK", 3)
    s, size = toxicity.Settings(l1=0.1), 8
    names = ["block", "z", "n", "toxic", "index"]

    def examples(k):
        index = [[0, 3, 6], [k, 5]]
        columns = [pa.nulls(2, pa.int32()), pa.nulls(2, pa.list_(pa.float64())), pa.nulls(2, pa.list_(pa.float64()))]
        return pa.RecordBatch.from_arrays([*columns, pa.array([1, k], pa.int32()), pa.array(index, pa.list_(pa.int32()))], names=names)

    z, n = np.zeros(size), np.zeros(size)
    z[-1], n[-1] = 0.7, 1.0
    first = [[*toxicity._round(k, size, 0.7, 4, s)(iter([examples(k)]))] for k in (0, 1)]
    ends = [next(toxicity._learner(_held(z, n), s)(iter([examples(k)]))) for k in (0, 1)]
    want = [sum(e[c].to_numpy() for e in ends) / 4 for c in ("z", "n")]
    rows = sorted((r for x in first for b in x for r in b.to_pylist()), key=lambda r: (r["block"], r["shard"]))
    states = pa.Table.from_pylist([{**r, "toxic": None, "index": None} for r in rows]).select(names)
    kinds = examples(0).schema
    states = states.cast(kinds).combine_chunks().to_batches()[0]
    mixed = pa.Table.from_batches([states, examples(1)]).combine_chunks().to_batches()
    for batches in (mixed, [states.slice(0, 2), states.slice(2), examples(1)]):
        (got,) = toxicity._round(1, size, None, 4, s)(iter(batches))
        again = next(toxicity._learner(_held(*want), s)(iter([examples(1)])))
        assert got["z"].values.to_pylist() == again["z"].to_pylist() and got["n"].values.to_pylist() == again["n"].to_pylist()
    assert [*toxicity._round(1, size, None, 4, s)(iter([states]))] == []


def _held(z, n):
    from types import SimpleNamespace

    return SimpleNamespace(value=(z.copy(), n.copy()))
