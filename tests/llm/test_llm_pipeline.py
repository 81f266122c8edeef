"""The pipeline, stage by stage, against plain Python over what the stage before has kept."""

from __future__ import annotations

import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))
sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402
from corpus import prose  # noqa: E402
from test_llm_operators import covered, decontaminate_words, edit_distance, shingles  # noqa: E402

tokenizers = pytest.importorskip("tokenizers")
public = pytest.importorskip("public_tokenizers")

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
INSULTS = ("snorfle", "grumbag", "wozzelig")


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    draw, rows, labels = random.Random(9), [], []
    passage, base = prose(draw, 60), prose(draw, 90)
    items = [(1, prose(draw, 30)), (2, prose(draw, 25))]
    for k in range(260):
        text = prose(draw, draw.randint(40, 90))
        if k % 5 == 0:
            text += f" You {draw.choice(INSULTS)}. " + prose(draw, 9)
        elif k % 29 == 1:
            text = base + " " + prose(draw, 2)
        elif k % 31 == 2:
            text += " " + passage
        elif k % 37 == 3:
            text += " " + items[k % 2][1] + " " + prose(draw, 5)
        rows.append((k, text, draw.choice(["en", None]), "s", len(text)))
        labels.append((k, 1, int(k % 5 == 0)))
    rows += [(300, None, None, None, None), (301, "", "en", "s", 0), (None, prose(draw, 30), "en", "s", 5), rows[1]]
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*SCHEMA.replace(",", "").split()[::2]).collect()), key=repr)


def one_of_each_class(rows):
    sets, kept, label = [shingles(r[1]) for r in rows], [], list(range(len(rows)))
    for _ in rows:
        label = [min([label[i], *[label[j] for j, b in enumerate(sets) if sets[i] and 5 * len(sets[i] & b) >= 4 * len(sets[i] | b)]])
                 for i in range(len(rows))]
        if label == [label[x] for x in label]:
            break
    for c in set(label):
        members = [rows[i] for i in range(len(rows)) if label[i] == c]
        if not shingles(members[0][1]):
            kept += members
        else:
            kept.append(min(members, key=lambda r: float("inf") if r[0] is None else r[0]))
    return sorted(kept, key=repr)


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "ngram_join", "suffix_dedup", "decontamination", "bpe"]
    stage = dict(corpus_pipeline.STAGES)

    clean = stage["toxicity"](spark, docs, folder)
    assert clean.columns == docs.columns
    want = [r for r in rows_of(docs) if not any(w in (r[1] or "") for w in INSULTS)]
    assert rows_of(clean) == want

    single = stage["ngram_join"](spark, spark.createDataFrame(want, SCHEMA), folder)
    want = one_of_each_class(want)
    assert rows_of(single) == want

    whole = stage["suffix_dedup"](spark, spark.createDataFrame(want, SCHEMA), folder)
    cut = []
    for r, b, f in covered(want):
        text = bytes(x for x, y in zip(b, f) if not y).decode("utf-8", "ignore")
        cut.append((r[0], text, *r[2:4], len(text)))
    want = sorted(cut, key=repr)
    assert rows_of(whole) == want

    items = [decontaminate_words(r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    left = stage["decontamination"](spark, spark.createDataFrame(want, SCHEMA), folder)
    fine = [r for r in want if all(edit_distance(i, decontaminate_words(r[1])) > int(0.2 * len(i) + 1e-9) for i in items)]
    assert len(fine) < len(want)
    assert rows_of(left) == fine

    library = tokenizers.Tokenizer.from_file(public.path("word_bpe_49k.json"))
    for r in stage["bpe"](spark, left, folder).collect():
        assert r.ids == library.encode(r.text, add_special_tokens=False).ids

    done = corpus_pipeline.run(spark, folder)
    assert rows_of(done) == fine and done.columns == [*docs.columns, "ids"]
