"""Operator 8: the classifier, its scoring and the documents that it scans."""

import random
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sluice.llm import license_scan as ls
from sluice.llm.common import table


@pytest.fixture(scope="module")
def model():
    return ls.train(["the quick brown fox", "unter den linden steht ein haus", "a file is open", "la casa de la familia"])


def scored(model, texts):
    data = np.frombuffer("\n".join(texts).encode(), dtype=np.uint8)
    owner, start, stop, count, feats = ls.line_features(data, np.array([0, len(data)]))
    return model.probabilities(count, feats), [data[a:b].tobytes().decode().strip() for a, b in zip(start, stop, strict=True)]


def test_scores_do_not_depend_on_neighbours(model):
    lines = ["Released under the MIT License.", "the the of is", "Licensed under CC BY-NC 4.0.", "x"]
    together, seen = scored(model, lines)
    assert seen == lines
    for i, x in enumerate(lines):
        assert together[i] == pytest.approx(scored(model, [x])[0][0])


def test_statements_are_recognised(model):
    said = {"Released under the MIT License.": "mit", "Licensed under the Apache License, Version 2.0.": "apache", "This work is licensed under the GNU General Public License, version 3.": "gpl", "Licensed under CC BY-NC 4.0.": "cc-by-nc", "We publish this under the Mozilla Public License.": "mpl", "All rights reserved.": "proprietary"}
    p, _ = scored(model, list(said))
    none = model.families.index(ls.NONE)
    for row, family in zip(p, said.values(), strict=True):
        assert row[none] < 0.5 and model.families[int(row[:none].argmax())] == family
    p, _ = scored(model, ["The license plate was lost in Paris.", "Otros de la casa fueron al mar.", "She studied at MIT."])
    assert (p[:, none] > 0.5).all()


def test_template_similarity():
    t = ls.Templates()
    assert t.similarity("mit", "Released under the MIT License.") == 1 and t.similarity("gpl", "Released under the MIT License.") == 0
    assert t.similarity("mit", "See notes. Released under the MIT License.") == 1


def test_documents(spark, model):
    rows = [(1, "Intro words\nReleased under the MIT License.\nLa fin", "a"), (2, None, "b"), (3, "", "c"), (4, "plain words only", "d"), (5, "\n\nLicensed under CC BY-NC 4.0.\n" * 3, "e"), (5, "x", "f"), (None, "All rights reserved.", "g")]
    df = spark.createDataFrame(rows, "doc_id long, text string, found string")
    got = sorted(((r["doc_id"], r["n_paragraphs"], r["n_licence"], r["n_confirmed"], r["families"]) for r in ls.summary(df, model).collect()), key=str)
    assert got == sorted([(1, 3, 1, 1, "mit"), (2, 0, 0, 0, ""), (3, 0, 0, 0, ""), (4, 1, 0, 0, ""), (5, 3, 3, 3, "cc-by-nc"), (5, 1, 0, 0, ""), (None, 1, 1, 1, "proprietary")], key=str)
    assert ls.summary(df.limit(0)).count() == 0
    first = ls.scan_documents(df, model).where("doc_id = 1").first()["found"][0]
    assert (first["paragraph"], first["text"], first["confirmed"]) == (1, "Released under the MIT License.", True)


def test_planted_lines_are_found_and_clean_documents_left_alone(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    names = {"Licensed under CC BY-NC 4.0.": "cc-by-nc", "This work is licensed under the GNU General Public License, version 3.": "gpl", "Licensed under the Apache License, Version 2.0.": "apache", "Released under the MIT License.": "mit", "All rights reserved.": "proprietary"}
    got = {r["doc_id"]: set(r["families"].split(",")) - {""} for r in ls.summary(docs).collect()}
    want = {r["doc_id"]: {f for x, f in names.items() if x in r["text"].split("\n")} for r in docs.collect()}
    assert sum(bool(f) for f in want.values()) > 10
    assert all(f <= got[i] for i, f in want.items())
    assert sum(bool(got[i] - f) for i, f in want.items()) <= 0.01 * len(want)


def test_statements_inside_long_lines_and_wrapped_notices(spark, sf):
    model = ls.train(ls.negatives(table(spark, sf, "documents")))
    prose = " ".join(f"plain words of a story {i} and more" for i in range(130))
    rows = [
        (1, prose + ". Released under the MIT License. " + prose), (2, prose + " Licensed under CC BY-NC 4.0 " + prose), (3, prose + "\n" + prose),
        (4, "Some tool\n\nThis Source Code Form is\nsubject to the terms of\nthe Mozilla Public License,\nv. 2.0.\n\nThe end"),
        (5, "Intro. Released under the MIT License. " + prose + ". Licensed under the Apache License, Version 2.0. The end"),
    ]
    got = {r["doc_id"]: (r["n_paragraphs"], r["n_confirmed"], r["families"]) for r in ls.summary(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    assert got == {1: (1, 1, "mit"), 2: (1, 1, "cc-by-nc"), 3: (2, 0, ""), 4: (6, 1, "mpl"), 5: (1, 2, "apache,mit")}


def test_blocks_are_whole_documents():
    t = pa.array(["a b\nc", None, "", "Released under the MIT License."] * 50)
    from sluice.llm import scan

    assert sum(end - row for row, end, _, _ in scan.blocks(t, 40)) == 200


def test_probabilities_against_plain_sums():
    """A paragraph's class probabilities: the weights of its words, pairs and triples, over the root of its
    words, plus the bias, in a softmax; computed here one feature at a time."""
    m = ls.train(["the weather was fine and the road was long", "nothing of the kind was said that day"])
    known = {int(h): w for h, w in zip(m.vocabulary, m.weight, strict=True)}
    lines = ["Licensed under the Apache License, Version 2.0.", "released under MIT", "the driver lost the plate", "x"]
    data = np.frombuffer("\n".join(lines).encode(), dtype=np.uint8)
    _, _, _, count, feats = ls.line_features(data, np.array([0, len(data)]))
    got = m.probabilities(count, feats)
    for line, n, p in zip(lines, count, got, strict=True):
        words = ls.tokens(line)
        assert n == len(words)
        z = m.bias.copy()
        for h in ls._one(line).tolist():
            if h in known:
                z = z + known[h] / np.sqrt(len(words))
        e = np.exp(z - z.max())
        assert np.allclose(p, e / e.sum())
    assert m.families[int(got[0].argmax())] == "apache" and m.families[int(got[2].argmax())] == ls.NONE


def test_many_statements_in_one_text(spark, model):
    """A megabyte of statements takes seconds: what overlaps is searched, not scanned."""
    lines = ["Released under the MIT License."] * 30_000
    docs = spark.createDataFrame([(1, "\n".join(lines))], "doc_id long, text string")
    t = time.perf_counter()
    got = ls.scan_documents(docs, model).select("n_paragraphs", F.size("found"), F.array_distinct("found.family"), F.array_distinct("found.confirmed")).first()
    assert tuple(got) == (len(lines), len(lines), ["mit"], [True])
    assert time.perf_counter() - t < 90


def test_spans_by_search_equal_a_scan():
    rng = random.Random(2)
    spans, plain = ls.Spans(), []
    for i in range(400):
        a = rng.randrange(5000)
        b = a + rng.choice([1, 3, 40, 700, 4000])
        entry = {"i": i}
        spans.add(a, b, i % 3, entry)
        plain.append((a, b, i % 3, entry))
        if i % 7 == 3:
            a, b, _, entry = plain.pop(rng.randrange(len(plain)))
            spans.drop(entry, a, b)
        a = rng.randrange(5000)
        b = a + rng.choice([1, 90, 1000])
        assert spans.over(a, b) == [x for x in plain if x[0] < b and a < x[1]]
