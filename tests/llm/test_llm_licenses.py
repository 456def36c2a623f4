from llm_fixtures import odd_documents

from daygrain.llm import licenses

MIT = " ".join(dict(licenses.RULES[:1])["MIT"])
BSD3, BSD2 = (list(r[1]) for r in licenses.RULES[1:3])


def found(spark, rows):
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, licenses int")
    return licenses.licenses(docs).collect()


def test_rules_over_sequences(spark):
    wrapped = "Intro line without end\n" + "\n".join(MIT[i:i + 60] for i in range(0, len(MIT), 60))
    rows = [
        (1, "Some code.\nReleased under the MIT License.\nmore"), (2, MIT), (3, " * " + " ".join(BSD3)), (4, "\n".join(BSD2)),
        (5, BSD2[1] + " " + BSD2[0]), (6, "LICENSED   under CC-BY-NC 4.0!\nLicensed under the Apache License, Version 2.0."),
        (7, "no ending\nReleased under the MIT License.\nnext"), (8, "This is not Released under the MIT License."),
        (9, "Released under the MIT License. " * 3), (10, "x. " + " ".join(licenses.RULES[4][1])),
    ]
    got = {r.doc_id: list(r.licenses) for r in found(spark, rows)}
    assert got == {
        1: ["MIT"], 2: ["MIT"], 3: ["BSD-3-Clause"], 4: ["BSD-2-Clause"], 5: [], 6: ["Apache-2.0", "CC-BY-NC-4.0"], 7: ["MIT"], 8: [],
        9: ["MIT"], 10: ["Apache-2.0"],
    }
    words = [w for w in wrapped.split()]
    [row] = found(spark, [(1, "Before it.\n" + "\n".join(" ".join(words[i:i + 7]) for i in range(4, len(words), 7)))])
    assert isinstance(row.licenses, list)
    [row] = found(spark, [(1, "Before it.\n" + MIT.replace(", ", ",\n"))])
    assert list(row.licenses) == ["MIT"]


def test_oddities(spark):
    rows = odd_documents()
    got = found(spark, rows)
    assert len(got) == len(rows) and all(list(r.sentences) == [] and list(r.licenses) == [] for r in got)
    assert found(spark, [(1, "Released under the MIT License.")] * 2) == found(spark, [(1, "Released under the MIT License.")]) * 2
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert licenses.licenses(docs).collect() == []


def test_longer_rules_come_first():
    made = licenses.compiled()
    sizes = [len(s) for _, s in made.rules]
    assert sizes == sorted(sizes, reverse=True) and len(set(made.sentences)) == len(made.sentences)
