"""License scans by a positional index of rare tokens."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlight.llm.common import SEPARATORS, let, text_of, words_of


@dataclass(frozen=True)
class Template:
    """A licence sentence, and the place of its mandatory key phrase (first word, number of words)."""

    label: str
    words: tuple[str, ...]
    key: tuple[int, int]


def template(label: str, before: str, key: str, after: str) -> Template:
    return Template(label, (*before.split(), *key.split(), *after.split()), (len(before.split()), len(key.split())))


#: Phrases whose every place counts; they are templates that are all key phrase.
BASE = (
    template("mit", "", "under the mit license", ""),
    template("apache-2", "", "apache license version 2", ""),
    template("cc-by-nc", "", "cc by nc", ""),
)
#: Sentences and notices that may differ from the template outside of the key phrase. The wording of the
#: public notices, without signs.
METHOD = (
    template("gpl", "this work is licensed under the", "gnu general public license", "version 3"),
    template("mit", "", "permission is hereby granted free of charge", "to any person obtaining a copy"),
    template("bsd", "", "redistribution and use in source and binary forms", "with or without modification are permitted"),
    template("cc-by", "licensed under a", "creative commons attribution", "international license"),
    template("mpl-2", "subject to the terms of the", "mozilla public license", "v 2 0"),
    template(
        "mit", "", "permission is hereby granted free of charge",
        "to any person obtaining a copy of this software and associated documentation files the software to deal in the software "
        "without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or "
        "sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following "
        "conditions the above copyright notice and this permission notice shall be included in all copies or substantial portions of "
        "the software",
    ),
    template(
        "bsd", "", "redistribution and use in source and binary forms",
        "with or without modification are permitted provided that the following conditions are met redistributions of source code "
        "must retain the above copyright notice this list of conditions and the following disclaimer redistributions in binary form "
        "must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or "
        "other materials provided with the distribution",
    ),
    template(
        "apache-2", "", "licensed under the apache license version 2",
        "0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at http "
        "www apache org licenses license 2 0 unless required by applicable law or agreed to in writing software distributed under the "
        "license is distributed on an as is basis without warranties or conditions of any kind either express or implied see the "
        "license for the specific language governing permissions and limitations under the license",
    ),
    template(
        "gpl", "this program is free software you can redistribute it and or modify it under the terms of the", "gnu general public license",
        "as published by the free software foundation either version 3 of the license or at your option any later version this "
        "program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of "
        "merchantability or fitness for a particular purpose see the gnu general public license for more details",
    ),
    template(
        "mpl-2", "this source code form is subject to the terms of the", "mozilla public license",
        "v 2 0 if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0",
    ),
    template(
        "isc", "", "permission to use copy modify and or distribute this software",
        "for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice "
        "appear in all copies",
    ),
)
#: Words of a template's key phrase whose postings are intersected, at most.
PROBES = 3
SHARE = 0.5


def rarest(docs: DataFrame, templates: tuple[Template, ...]) -> list[list[int]]:
    """For each template, the places in it of the key words with the highest IDF over all of ``docs``.

    Document counts are taken of licence words only, so the driver gets one row for each of them.
    """
    vocabulary = sorted({w for t in templates for w in t.words[t.key[0] : sum(t.key)]})
    present = F.array_distinct(F.filter(words_of(text_of()), lambda w: w.isin(vocabulary)))
    counted = docs.select(F.explode(present).alias("word")).groupBy("word").count().collect()
    seen = {r["word"]: r["count"] for r in counted}
    return [sorted(range(t.key[0], sum(t.key)), key=lambda n: (seen.get(t.words[n], 0), n))[:PROBES] for t in templates]  # noqa: B023


def _starts(words: Column, hits: Column, t: Template, rare: list[int]) -> Column:
    """First places of ``t`` (may be before the text) where its key phrase stands.

    The postings of its rarest key words, shifted to the template's start, are intersected; the phrase is verified on
    what is left.
    """
    first, n = t.key
    phrase = F.array(*[F.lit(w) for w in t.words[first : first + n]])
    shifted = [F.transform(F.filter(hits, lambda h: h["word"] == t.words[r]), lambda h: h["place"] - r) for r in rare]  # noqa: B023
    places = reduce(F.array_intersect, shifted)
    return F.filter(places, lambda s: (s + first >= 0) & (F.slice(words, F.greatest(s + first, F.lit(0)) + 1, n) == phrase))


def _share(words: Column, t: Template) -> callable:
    """The share of the template's words that stand at their relative places, for a first place."""

    def share(s: Column) -> Column:
        wanted = F.array(*[F.lit(w) for w in t.words])
        same = F.filter(F.sequence(F.lit(0), F.lit(len(t.words) - 1)), lambda n: F.get(words, s + n) == F.get(wanted, n))
        return F.size(same) / float(len(t.words))

    return share


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) of every row of ``docs``.

    Each file's licence words of the highest IDF are looked up in the index; the postings of a template's words are
    intersected by relative position, and there the key phrase must stand word for word. Base phrases are all key phrase. The other templates
    also need at least half of their words at the relative places. ``score`` is the largest share of a template that
    stands (1 with a base phrase), 0 without any. Null and empty texts have no words and no labels. Repeated rows are
    repeated, an empty table gives no rows, other columns are ignored. All of it are column functions of one row; only
    the counts for the IDF are shuffled, one row for each licence word and task.
    """
    templates = BASE + METHOD
    rare = rarest(docs, templates)
    wanted = sorted({t.words[n] for t, places in zip(templates, rare, strict=True) for n in places})

    def result(words: Column, hits: Column) -> Column:
        found = [_starts(words, hits, t, n) for t, n in zip(templates, rare, strict=True)]
        base = F.array(*found[: len(BASE)])
        shares = F.array(*[
            F.coalesce(F.array_max(F.transform(starts, _share(words, t))), F.lit(0.0))
            for t, starts in zip(METHOD, found[len(BASE) :], strict=True)
        ])

        def of(base: Column, shares: Column) -> Column:
            places = F.flatten(base)
            named = [F.when(F.size(base[n]) > 0, t.label) for n, t in enumerate(BASE)]
            more = [F.when(shares[n] >= SHARE, t.label) for n, t in enumerate(METHOD)]

            def joined(names: list[Column]) -> Column:
                return F.array_join(F.array_sort(F.array_distinct(F.array_compact(F.array(*names)))), ",")

            best = F.array_max(F.transform(shares, lambda x: F.when(x >= SHARE, x).otherwise(0.0)))
            return F.struct(
                F.size(words).cast("long").alias("n_words"), F.size(places).cast("long").alias("n_base"),
                F.array_min(places).cast("long").alias("first_word"), F.array_max(places).cast("long").alias("last_word"),
                joined(named).alias("base_labels"), joined(named + more).alias("labels"),
                F.when(F.size(places) > 0, 1.0).otherwise(best).alias("score"),
            )

        return let(base, lambda b: let(shares, lambda s: of(b, s)))

    def hits_of(words: Column) -> Column:
        placed = F.transform(words, lambda w, n: F.when(w.isin(wanted), F.struct(w.alias("word"), n.alias("place"))))
        return F.filter(placed, lambda h: h.isNotNull())

    whole = let(words_of(text_of()), lambda words: let(hits_of(words), lambda hits: result(words, hits)))
    return docs.select("doc_id", whole.alias("_r")).select("doc_id", "_r.*")


def scan_sql() -> str:
    """The rows of ``scan`` over ``documents`` in SQL: every start is tried, without the index."""

    def at(t: Template, n: int, s: str) -> str:
        return f"COALESCE(w[{s} + {n + 1}] = '{t.words[n]}', FALSE)"

    def starts(t: Template) -> str:
        key = " AND ".join(at(t, n, "s") for n in range(t.key[0], sum(t.key)))
        return f"list_filter(range(-{t.key[0]}, len(w)), lambda s: s + {t.key[0]} >= 0 AND {key})"

    def share(t: Template) -> str:
        same = " + ".join(f"(CASE WHEN s + {n} >= 0 AND {at(t, n, 's')} THEN 1 ELSE 0 END)" for n in range(len(t.words)))
        return f"COALESCE(list_max(list_transform({starts(t)}, lambda s: CAST({same} AS DOUBLE) / {len(t.words)}.0)), 0.0)"

    base = ", ".join(f"{starts(t)} AS b{n}" for n, t in enumerate(BASE))
    shares = ", ".join(f"{share(t)} AS m{n}" for n, t in enumerate(METHOD))
    named = ", ".join(f"CASE WHEN len(b{n}) > 0 THEN '{t.label}' END" for n, t in enumerate(BASE))
    more = ", ".join(f"CASE WHEN m{n} >= {SHARE} THEN '{t.label}' END" for n, t in enumerate(METHOD))
    places = " || ".join(f"b{n}" for n in range(len(BASE)))
    best = ", ".join(f"CASE WHEN m{n} >= {SHARE} THEN m{n} ELSE 0.0 END" for n in range(len(METHOD)))

    def joined(names: str) -> str:
        return f"COALESCE(array_to_string(list_sort(list_distinct(list_filter([{names}], lambda x: x IS NOT NULL))), ','), '')"

    lower = "translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
WITH split AS (
  SELECT doc_id, list_filter(string_split_regex({lower}, '{SEPARATORS}'), lambda x: x <> '') AS w FROM documents
), found AS (SELECT doc_id, w, {base}, {shares} FROM split),
placed AS (SELECT *, {places} AS p FROM found)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(p) AS BIGINT) AS n_base,
  CAST(list_min(p) AS BIGINT) AS first_word, CAST(list_max(p) AS BIGINT) AS last_word,
  {joined(named)} AS base_labels, {joined(named + ", " + more)} AS labels,
  CASE WHEN len(p) > 0 THEN CAST(1 AS DOUBLE) ELSE CAST(greatest({best}) AS DOUBLE) END AS score
FROM placed"""
