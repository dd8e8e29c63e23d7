import duckdb

import __spark_entry__ as entry
from check import TABLES, rows_of
from martlight.llm import licenses, registry

SCHEMA = "doc_id long, text string, n_words string, word string"


def test_equals_sql(spark, small):
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{small}/{table}.parquet'")
    frame = registry.op10_license_scan(spark, small)
    result = db.execute(licenses.scan_sql())
    want = rows_of([d[0] for d in result.description], result.fetchall())
    assert rows_of(frame.columns, [tuple(r) for r in frame.collect()]) == want
    assert any(r[1] for r in want) and "Python" not in frame._jdf.queryExecution().toString()
    assert "op10_license_scan" in entry.queries()


def test_places_labels_and_scores(spark):
    rows = [
        (1, "Under the MIT License, under-the-mit-license. CC BY NC", "", ""),
        (2, "This work is licensed under the GNU General Public License, version 3.", "", ""),
        (3, "x GNU general public license for", "", ""),
        (4, "apache license version 2é apache license version", "", ""),
        (5, "mit license under the mit", None, None),
        (6, None, "", ""),
        (7, "", "", ""),
        (None, "é " * 40_000 + "Apache License\nVersion 2.0", "", ""),
        (8, "Permission is hereby granted, free of charge, to any person", "", ""),
        (8, "Permission is hereby granted, free of charge, to any person", "", ""),
    ]
    got = sorted((tuple(r) for r in licenses.scan(spark.createDataFrame(rows, SCHEMA)).collect()), key=lambda r: r[0] or 0)
    assert got == [
        (None, 40_005, 1, 40_000, 40_000, "apache-2", "apache-2", 1.0),
        (1, 11, 3, 0, 8, "cc-by-nc,mit", "cc-by-nc,mit", 1.0),
        (2, 12, 0, None, None, "", "gpl", 1.0),
        (3, 6, 0, None, None, "", "", 0.0),
        (4, 7, 0, None, None, "", "", 0.0),
        (5, 5, 0, None, None, "", "", 0.0),
        (6, 0, 0, None, None, "", "", 0.0),
        (7, 0, 0, None, None, "", "", 0.0),
        *[(8, 10, 0, None, None, "", "mit", 10 / 13)] * 2,
    ]
    assert licenses.scan(spark.createDataFrame([], SCHEMA)).count() == 0


def test_whole_notices_and_scattered_words(spark):
    notices = [t for t in licenses.METHOD if len(t.words) > 30]
    assert {t.label for t in notices} == {"mit", "bsd", "apache-2", "gpl", "mpl-2", "isc"}
    texts = [f"// Copyright someone. {' '.join(t.words).upper()} end" for t in notices]
    # every third word after the key phrase changed: still over half; the key words scattered: nothing
    changed = [" ".join("other" if n >= sum(t.key) and n % 3 == 0 else w for n, w in enumerate(t.words)) for t in notices]
    scattered = [" x ".join(reversed(t.words[t.key[0] : sum(t.key)])) for t in notices]
    docs = spark.createDataFrame(list(enumerate(texts + changed + scattered)), "doc_id long, text string")
    got = {r.doc_id: (r.labels.split(","), r.score) for r in licenses.scan(docs).collect()}
    for n, t in enumerate(notices):
        assert t.label in got[n][0] and got[n][1] == 1.0
        assert t.label in got[n + len(notices)][0] and got[n + len(notices)][1] >= licenses.SHARE
        assert got[n + 2 * len(notices)] == ([""], 0.0)
