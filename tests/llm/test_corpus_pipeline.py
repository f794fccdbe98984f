import random

import corpus_pipeline as cp
from zonalspark.llm import decontaminate as dc
from zonalspark.llm import ngram_join as nj
from zonalspark.llm import toxicity as tx


def test_stages(spark, tmp_path):
    rng = random.Random(8)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 8))) for _ in range(500)]
    say = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    item = say(40)
    secret = "".join(rng.choice("0123456789abcdef") for _ in range(40))
    rows, labels = [], []
    for i in range(600):
        toxic = i % 5 == 0
        text = say(30) + ". " + say(20) + (" grumblewort " if toxic else " ") + say(10) + "."
        if i % 50 == 1:
            text = rows[0][1] if i == 1 else rows[1][1].replace(" ", "  ", 1)
        if i % 97 == 7:
            text += " " + item
        if i % 89 == 3:
            text += f' token = "{secret}"'
        rows.append((i, text, "en", "src", len(text)))
        if i % 2 == 0:
            labels.append((i, 1, int(toxic)))
    rows += [(1000, None, None, None, None), (1001, "", "en", "src", 0)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for name, data, s in (("documents", rows, schema), ("labels", labels, "doc_id long, quality int, toxic int"), ("benchmark", [(1, item)], "item_id long, text string")):
        spark.createDataFrame(data, s).write.parquet(f"{tmp_path}/{name}.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = {}
    for name, stage in cp.STAGES:
        before = {r["doc_id"]: r for r in docs.collect()}
        docs = cp._text.written(stage(spark, docs, str(tmp_path)), name)
        kept[name] = {r["doc_id"] for r in docs.collect()}
        if name == "toxicity":
            model = tx.fit(tx.training_rows(spark.read.parquet(f"{tmp_path}/documents.parquet"), spark.read.parquet(f"{tmp_path}/labels.parquet")))
            scores = {r["doc_id"]: r["score"] for r in tx.score(spark.read.parquet(f"{tmp_path}/documents.parquet"), model).collect()}
            assert kept[name] == {i for i, s in scores.items() if s < tx.THRESHOLD}
            assert len({i for i in range(600) if i % 5 == 0 and i % 50 != 1} & kept[name]) < 10 and len(kept[name]) > 460
        elif name == "ngram_jaccard_join":
            sequences = {}
            for i, r in sorted(before.items()):
                sequences.setdefault(tuple(dc.item_words(r["text"])) or i, i)
            assert kept[name] == set(sequences.values())  # only exact copies were planted
        elif name == "benchmark_decontamination":
            assert kept[name] == {i for i, r in before.items() if not dc.brute_force(r["text"], [(1, item)])[4]}
        elif name == "secret_scans":
            after = {r["doc_id"]: r for r in docs.collect()}
            for i, r in before.items():
                want = (r["text"] or "").replace(secret, "<SECRET>")
                assert (after[i]["text"] or "") == want and after[i]["n_chars"] == (len(want) if secret in (r["text"] or "") else r["n_chars"])
    assert kept["packing"] == kept["secret_scans"]
    assert {r["doc_id"] for r in cp.run(spark, str(tmp_path)).collect()} == kept["packing"]
    assert nj.THRESHOLD == 0.8 and nj.N == 5
