"""Nearest neighbours and license scans against brute force and hand-made cases."""

import duckdb
import numpy as np
import pytest

from quern.llm import nearest as ann
from quern.llm.licenses import TEMPLATES, licenses_sql, scan_licenses
from quern.llm.nearest import nearest

DIVISIBLE = lambda c: c % 50 == 0


def brute(rows, k=5):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], dtype=float)
    x = x / np.linalg.norm(x, axis=1)[:, None]
    out = {}
    for q in np.flatnonzero(ids % 50 == 0):
        score = x @ x[q]
        score[q] = -np.inf
        order = np.lexsort((ids, -score))[: min(k, len(ids) - 1)]
        out[int(ids[q])] = [(int(ids[i]), float(score[i])) for i in order]
    return out


def test_recall_and_scores(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    want = brute([(r.vec_id, r.embedding) for r in vectors.collect()])
    got = {}
    for r in nearest(vectors, DIVISIBLE).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert set(got) == set(want) and all(len(v) == 5 for v in got.values())
    for q, found in got.items():
        assert [s for _, s in found] == sorted((s for _, s in found), reverse=True)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits / (5 * len(want)) >= 0.9


def test_large_classes_and_splits(spark, monkeypatch):
    monkeypatch.setattr(ann, "SPLIT_ROWS", 40)
    monkeypatch.setattr(ann, "GROUP_ROWS", 100)
    rng = np.random.default_rng(2)
    same = [1.0, 2.0, 3.0, 4.0]
    rows = [(i, same if i % 3 == 0 else (np.array(same) + 0.01 * rng.normal(size=4)).tolist()) for i in range(600)]
    got = {}
    for r in nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), DIVISIBLE).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    for q, found in brute(rows).items():
        assert [round(s, 12) for _, s in got[q]] == pytest.approx([round(s, 12) for _, s in found])
        if q % 3 == 0:
            assert [i for i, _ in got[q]] == [i for i in range(0, 600, 3) if i != q][:5]


def test_unsound_vectors_and_few_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [-1.0, 0.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [None, 1.0]), (50, [1.0, 1.0, 1.0]), (None, [1.0, 0.0]), (0, [1.0, 0.0])]
    vectors = spark.createDataFrame([(i, v, "x", 1.0) for i, v in rows], "vec_id long, embedding array<double>, query string, score double")
    found = [tuple(r) for r in nearest(vectors, DIVISIBLE).orderBy("query_id", "rank").collect()]
    assert found == [(0, 1, 1, 0.0), (0, 2, 2, -1.0)]
    assert nearest(vectors.limit(0), DIVISIBLE).count() == 0


CASES = [
    None,
    "",
    "Apache License and APACHE-LICENSE, apachelicense; an apache\nlicense",
    "gnu general public license gnu general public license mit license cc by",
    "cc  by-nc; CC/BY",
    "éapache license apache licenseé",
    "Licensed under the Apache License, Version 2.0.\nReleased under the MIT License.",
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that all conditions are met",
    "All rights reserved. No part may be reproduced without permission.",
    "word " * 30_000 + "mit license",
    "Licensed under CC BY-NC 4.0.",
    "Licensed under CC BY-NC 4.0.",
]


@pytest.mark.parametrize("templates", [TEMPLATES, TEMPLATES[:1]])
def test_licenses_against_sql(spark, templates):
    rows = [(i, t, "s", 0.5) for i, t in enumerate(CASES)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, score double")
    got = sorted(tuple(r) for r in scan_licenses(docs, templates=templates).collect())
    db = duckdb.connect()
    db.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    db.executemany("INSERT INTO documents VALUES (?, ?)", [(i, t) for i, t in enumerate(CASES)])
    assert got == sorted(db.execute(licenses_sql(templates)).fetchall())
    assert got[0] == (0, 0, 0, None, None, "", "", 0.0)
    assert got[2][2:5] == (3, 0, 7)
    assert got[9][1:5] == (30_002, 1, 30_000, 30_000)


def test_licenses_edges(spark):
    docs = spark.createDataFrame([(None, "mit license"), (1, "mit license"), (1, None)], "doc_id long, text string")
    assert sorted(str(r.doc_id) + r.base_labels for r in scan_licenses(docs).collect()) == ["1", "1mit", "Nonemit"]
    assert scan_licenses(docs.limit(0)).count() == 0


WRAPPED = [
    ("mit-notice", "# Permission is hereby granted, free of charge, to any person obtaining a copy\n# of this software and associated documentation files (the \"Software\"), to deal\n"),
    ("bsd", " * Redistribution and use in source and binary forms, with or without\n * modification, are permitted provided that the following conditions\n * are met:\n"),
    ("gpl-notice", "This program is free software: you can redistribute it\nand/or modify it under the terms of the GNU\nGeneral Public\nLicense as published by\n"),
]


@pytest.mark.parametrize("before", [0, 13, 30])
def test_wrapped_notices(spark, before):
    lead = "".join(f"line {i} of code\n" for i in range(before))
    docs = spark.createDataFrame([(i, lead + t + lead) for i, (_, t) in enumerate(WRAPPED)], "doc_id long, text string")
    found = {r.doc_id: r for r in scan_licenses(docs).collect()}
    for i, (label, text) in enumerate(WRAPPED):
        assert label in found[i].labels.split(",") and found[i].score >= 0.8
    plain = spark.createDataFrame([(1, "no notice\nat all in\nthese lines\n" * 40)], "doc_id long, text string")
    assert [(r.n_words, r.labels, r.score) for r in scan_licenses(plain).collect()] == [(280, "", 0.0)]


LABELS = [
    ("Licensed under CC BY-NC 4.0.", "cc-by,cc-by-nc-4.0"),
    ("Licensed under CC BY-SA 4.0.", "cc-by,cc-by-sa-4.0"),
    ("Licensed under CC BY-NC-SA 4.0.", "cc-by"),
    ("Released under the BSD License.", ""),
    ("Released under the Apache License.", "apache"),
    ("Released under the\n# MIT License.", "mit,mit-notice"),
    ("Licensed under the MIT License, Version 2.0", "mit"),
    ("Our new album was released\nlast week under a deal with the mit press\nand a license.", ""),
    ("This work is licensed\nunder a Creative Commons Attribution 4.0 International License", "cc-by-4.0"),
    ("This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License", ""),
    ("text before. All rights reserved.\ntext", "proprietary"),
    ("all the seats are reserved and rights do not come into it", ""),
    ("GNU Lesser General Public License, version 3: this work is licensed under the", ""),
    ("This work is licensed under the GNU General Public\n * License, version 3.", "gpl,gpl-3.0"),
]


def test_labels_need_their_telling_words_close_together(spark):
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(LABELS)], "doc_id long, text string")
    found = {r.doc_id: r.labels for r in scan_licenses(docs).collect()}
    assert [found[i] for i in range(len(LABELS))] == [want for _, want in LABELS]
    db = duckdb.connect()
    db.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    db.executemany("INSERT INTO documents VALUES (?, ?)", [(i, t) for i, (t, _) in enumerate(LABELS)])
    assert {r[0]: r[6] for r in db.execute(licenses_sql()).fetchall()} == found


def test_given_documents_against_sql(spark):
    path = "/root/testdata/sf0.1/documents.parquet"
    got = sorted(tuple(r) for r in scan_licenses(spark.read.parquet(path)).collect())
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{path}')")
    assert got == sorted(db.execute(licenses_sql()).fetchall())
    labels = {label for r in got for label in r[6].split(",")}
    assert "cc-by-nc-4.0" in labels and "cc-by-sa-4.0" not in labels
    assert not [r for r in got if "mit-notice" in r[6] and "mit" not in r[5].split(",")]
    reserved = db.execute("SELECT count(*) FROM documents WHERE text LIKE '%All rights reserved.%'").fetchall()[0][0]
    assert sum("proprietary" in r[6] for r in got) >= reserved > 0


OTHERS = [
    ("fr", "Tous droits réservés À LA société Éditions", "", ""),
    ("de", "Alle Rechte VORBEHALTEN gemäß ÜBEREINKUNFT", "rechte vorbehalten", ""),
    ("reserved", "All rights reserved.", "rights reserved copyright", ""),
]
NOTICES = [
    ("TOUS droits réservés À la société Éditions", "fr", 1.0),
    ("tous droits réservés à la société éditions", "", 0.0),
    ("alle rechte vorbehalten gemäß ÜBEREINKUNFT", "de", 1.0),
    ("alle rechte vorbehalten gemäß übereinkunft", "de", 0.8),
    ("All rights reserved. Copyright", "reserved", 1.0),
    ("All rights reserved.", "", 0.0),
]


def test_templates_with_other_capitals_or_telling_words_beyond_their_text(spark):
    rows = [(i, t) for i, (t, _, _) in enumerate(NOTICES)]
    got = sorted(tuple(r) for r in scan_licenses(spark.createDataFrame(rows, "doc_id long, text string"), templates=OTHERS).collect())
    assert [(r[6], r[7]) for r in got] == [(label, score) for _, label, score in NOTICES]
    db = duckdb.connect()
    db.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    db.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    assert got == sorted(db.execute(licenses_sql(OTHERS)).fetchall())
