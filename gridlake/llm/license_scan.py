"""Licence scan by sentence rules.

A text is cut into sentences, each sentence is brought to a normal form (ASCII lower case, one spelling of
*licence*, no marks or years of a copyright line, single blanks) and looked up in the list of known licence
sentences. What remains of a text is the sequence of identifiers of its known sentences. Ordered rules then read
this sequence: a rule is a sequence of identifiers that must follow each other, the first rules are the most
specific ones, and what a rule has read is not read again by a later one.

Notices are wrapped, often in comments. So known sentences are looked for in runs of lines, and of parts between colons
and semicolons, that begin where a known sentence can begin: the longest run whose joined normal form is known counts.
A run ends at a full stop and at an empty line (one without ASCII letters and digits), but for that before the address
of the Apache licence. ``n_sentences`` counts the parts between end marks and line breaks, wrapped or not.

Only built-in functions are used. A document's sentences stay in its row (an array), so nothing is shuffled, and a
hot source or a group of copies is no more work than other rows. The known sentences and the rules are fixed and
small; they become literals of the plan.

Defined results: a null or empty text has no sentences, empty sequences and ``false``; repeated rows are judged
each; an empty table gives an empty result; other columns are left out of the query and don't clash with it.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlake.llm.secret_scan import _let

#: Known sentences in normal form, and their identifiers (fixed values).
SENTENCES = {
    "all rights reserved": "AllRights",
    "released under the mit license": "MITref",
    "licensed under the mit license": "MITref",
    "this project is licensed under the mit license": "MITref",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "MITgrant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "MITnotice",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement": "MITasis",
    "licensed under the apache license version 2 0": "Apache2ref",
    "licensed under the apache license version 2 0 the license": "Apache2ref",
    "you may not use this file except in compliance with the license": "ApacheComply",
    "you may obtain a copy of the license at http www apache org licenses license 2 0": "ApacheCopy",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied": "ApacheAsIs",
    "see the license for the specific language governing permissions and limitations under the license": "ApacheSee",
    "this work is licensed under the gnu general public license version 3": "GPL3ref",
    "this work is licensed under the gnu general public license version 2": "GPL2ref",
    "licensed under the gnu general public license version 3": "GPL3ref",
    "licensed under the gnu general public license version 2": "GPL2ref",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "GPL3plus",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version": "GPL2plus",
    "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose": "GPLwarranty",
    "see the gnu general public license for more details": "GPLsee",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "BSDgrant",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "BSDsource",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "BSDbinary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "BSDnames",
    "licensed under cc by nc 4 0": "CCBYNC4ref",
    "licensed under cc by sa 4 0": "CCBYSA4ref",
    "licensed under cc by 4 0": "CCBY4ref",
    "this work is licensed under a creative commons attribution 4 0 international license": "CCBY4ref",
    "this is free and unencumbered software released into the public domain": "Unlicense",
}

#: Ordered rules: the licence, and identifiers that follow each other (fixed values).
RULES = (
    ("MIT", ("MITgrant", "MITnotice", "MITasis")),
    ("MIT", ("MITgrant", "MITnotice")),
    ("Apache-2.0", ("Apache2ref", "ApacheComply", "ApacheCopy", "ApacheAsIs", "ApacheSee")),
    ("GPL-3.0-or-later", ("GPL3plus", "GPLwarranty", "GPLsee")),
    ("GPL-2.0-or-later", ("GPL2plus", "GPLwarranty", "GPLsee")),
    ("BSD-3-Clause", ("BSDgrant", "BSDsource", "BSDbinary", "BSDnames")),
    ("BSD-2-Clause", ("BSDgrant", "BSDsource", "BSDbinary")),
    ("Apache-2.0", ("Apache2ref",)),
    ("MIT", ("MITref",)),
    ("GPL-3.0-or-later", ("GPL3plus",)),
    ("GPL-2.0-or-later", ("GPL2plus",)),
    ("GPL-3.0-only", ("GPL3ref",)),
    ("GPL-2.0-only", ("GPL2ref",)),
    ("CC-BY-NC-4.0", ("CCBYNC4ref",)),
    ("CC-BY-SA-4.0", ("CCBYSA4ref",)),
    ("CC-BY-4.0", ("CCBY4ref",)),
    ("Unlicense", ("Unlicense",)),
    ("proprietary", ("AllRights",)),
)

#: A sentence ends at a line break that ends a paragraph or line, or at an end mark before a blank.
SENTENCE_END = r"[.!?:;]+[ \t\r\n]+|\n+"
MARKS = r"[^0-9a-z]+"
YEARS = r"^copyright( c)?( [0-9]{4})+ "
#: What ends a run of lines, what parts it, and the address that follows an empty line.
RUN_END = r"[.!?]+[ \t\r\n]+|\n(?:[^0-9A-Za-z\n]*\n)++"
RUN_PART = r"[:;]+[ \t\r\n]+|\n+"
#: Identifiers that are gathered at a time: appending to a list copies it.
TOGETHER = 256
ADDRESS = r"(?i)(copy[^0-9a-z]+of[^0-9a-z]+the[^0-9a-z]+licen[cs]e[^0-9a-z]+at)[^0-9a-z]+(http)"


def sentences(text: Column) -> Column:
    """Sentences of a text that hold anything but blanks; null has none."""
    cut = F.split(F.coalesce(text, F.lit("")), SENTENCE_END)
    return F.filter(cut, lambda s: F.length(F.trim(s)) > 0)


def _plain(text: Column) -> Column:
    """Words in lower case, parted by one blank each. Parts that are joined by blanks have joined plain forms."""
    return F.replace(F.trim(F.regexp_replace(F.lower(text), MARKS, " ")), F.lit("licence"), F.lit("license"))


def normal_form(sentence: Column) -> Column:
    return F.regexp_replace(_plain(sentence), YEARS, "")


def _opener(names: dict[str, str]) -> str:
    """A pattern of the first two words of known sentences, or a copyright line, at the start of a part of a run."""
    starts = {r"[^0-9a-z]+".join(s.split(" ")[:2]).replace("license", "licen[sc]e") for s in names}
    return rf"(?im)(?:^|[:;][ \t\r\n]+)[^0-9a-z]*(?:{'|'.join(sorted(starts))}|copyright[^0-9a-z])"


def _known(run: Column, known: Column, opener: str, parts: int) -> Column:
    """Identifiers of the known sentences in a run, in order: from each part on, the longest one of ``parts`` at most."""
    texts = F.filter(F.transform(F.split(run, RUN_PART), _plain), lambda s: s != "")
    none = F.array().cast("array<string>")

    def fold(held: Column) -> Column:
        def step(acc, k):
            named = lambda near, n: F.struct(n.alias("n"), F.try_element_at(known, F.regexp_replace(F.array_join(F.slice(near, F.lit(1), n), " "), YEARS, "")).alias("id"))
            # the parts at hand are taken once: a slice costs as much as the run is long
            found = _let(F.slice(held, k, parts), lambda near: F.filter(F.transform(F.sequence(F.lit(1), F.size(near)), lambda n: named(near, n)), lambda x: x["id"].isNotNull()))
            # a part that goes on with a sentence opened before is not looked at; nor one that opens none
            looked = F.when((k > acc["done"]) & (F.concat(F.element_at(held, k), F.lit(" "), F.coalesce(F.try_element_at(held, k + 1), F.lit(""))).rlike(opener)), F.try_element_at(found, F.lit(-1)))
            full = F.size(acc["ids"]) >= TOGETHER
            return F.transform(F.array(looked), lambda x: F.struct(
                F.when(x.isNotNull(), k + x["n"] - 1).otherwise(acc["done"]).alias("done"),
                F.when(x.isNull(), acc["ids"]).when(full, F.array(x["id"])).otherwise(F.concat(acc["ids"], F.array(x["id"]))).alias("ids"),
                F.when(x.isNotNull() & full, F.concat(acc["before"], F.array(acc["ids"]))).otherwise(acc["before"]).alias("before")))[0]

        start = F.struct(F.lit(0).alias("done"), none.alias("ids"), F.array().cast("array<array<string>>").alias("before"))
        whole = lambda acc: F.flatten(F.concat(acc["before"], F.array(acc["ids"])))
        return F.when(F.size(held) > 0, F.aggregate(F.sequence(F.lit(1), F.size(held)), start, step, whole)).otherwise(none)

    return F.flatten(F.transform(F.array(texts), fold))


def scan(df: DataFrame, text: Column, names: dict[str, str] = SENTENCES, rules=RULES) -> DataFrame:
    """``df`` with n_sentences, sentence_ids, licenses and unread_ids (known sentences that no rule has read)."""
    known = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    opener, parts = _opener(names), max(len(x.split(" ")) for x in names)
    runs = F.filter(F.split(F.regexp_replace(F.coalesce(text, F.lit("")), ADDRESS, "$1 $2"), RUN_END), lambda r: r.rlike(opener))
    out = (
        df.withColumn("_sentences", sentences(text))
        .withColumn("n_sentences", F.size("_sentences").cast("long"))
        .withColumn("_ids", F.flatten(F.transform(runs, lambda r: _known(r, known, opener, parts))))
        .withColumn("sentence_ids", F.array_join("_ids", ","))
        .withColumn("_rest", F.when(F.size("_ids") > 0, F.concat(F.lit(","), F.array_join("_ids", ",,"), F.lit(","))).otherwise(""))
    )
    found = []
    rest = F.col("_rest")
    for k, (licence, ids) in enumerate(rules):
        spelt = "," + ",,".join(ids) + ","
        found.append(F.when(rest.contains(spelt), F.lit(licence)))
        out = out.withColumn(f"_hit{k}", found[-1]).withColumn("_rest", F.replace(rest, F.lit(spelt), F.lit("|")))
    hits = [f"_hit{k}" for k in range(len(rules))]
    return (
        out.withColumn("licenses", F.array_join(F.array_distinct(F.array_compact(F.array(*hits))), ","))
        .withColumn("unread_ids", F.array_join(F.filter(F.split("_rest", r"[,|]+"), lambda x: x != ""), ","))
        .drop("_sentences", "_ids", "_rest", *hits)
    )


def op1_license_scan(spark, sf_dir: str) -> DataFrame:
    """Per document: doc_id, n_sentences, sentence_ids, licenses (in the order of the rules), licensed, unread_ids."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = scan(docs, F.col("text"))
    return found.select("doc_id", "n_sentences", "sentence_ids", "licenses",
                        (F.col("licenses") != "").alias("licensed"), "unread_ids")


def oracle() -> str:
    names = ", ".join(f"('{s}', '{i}')" for s, i in SENTENCES.items())
    steps, prev = [], "seq"
    for k, (_, ids) in enumerate(RULES):
        spelt = "," + ",,".join(ids) + ","
        steps.append(f"r{k} AS (SELECT *, contains(rest, '{spelt}') AS h{k} FROM (SELECT * FROM {prev}))")
        steps.append(f"s{k} AS (SELECT * REPLACE (replace(rest, '{spelt}', '|') AS rest) FROM r{k})")
        prev = f"s{k}"
    order = list(dict.fromkeys(licence for licence, _ in RULES))
    first = {x: min(k for k, r in enumerate(RULES) if r[0] == x) for x in order}

    def place(x: str) -> str:
        rows = [k for k, r in enumerate(RULES) if r[0] == x]
        return " ".join(f"WHEN h{k} THEN {k}" for k in rows)

    return f"""WITH known(sentence, id) AS (VALUES {names}),
cut AS (SELECT doc_id, row_number() OVER () AS rid, list_filter(string_split_regex(coalesce(text, ''), '[.!?:;]+[ \\t\\r\\n]+|\\n+'), lambda s: length(trim(s)) > 0) AS parts FROM documents),
each_one AS (SELECT rid, unnest(range(len(parts))) AS k, unnest(parts) AS s FROM cut),
ids AS (SELECT rid, list(id ORDER BY k) AS ids FROM each_one JOIN known
  ON known.sentence = regexp_replace(replace(trim(regexp_replace(lower(s), '[^0-9a-z]+', ' ', 'g')), 'licence', 'license'), '^copyright( c)?( [0-9]{{4}})+ ', '') GROUP BY rid),
seq AS (SELECT doc_id, len(parts) AS n_sentences, coalesce(array_to_string(ids, ','), '') AS sentence_ids,
  CASE WHEN ids IS NULL THEN '' ELSE ',' || array_to_string(ids, ',,') || ',' END AS rest FROM cut LEFT JOIN ids USING (rid)),
{", ".join(steps)},
named AS (SELECT *, list_transform(list_sort(list_filter([{", ".join(f"CASE {place(x)} END" for x in order)}], lambda x: x IS NOT NULL)), lambda x: [{", ".join(f"'{r[0]}'" for r in RULES)}][x + 1]) AS l FROM {prev})
SELECT doc_id, CAST(n_sentences AS BIGINT) AS n_sentences, sentence_ids, array_to_string(l, ',') AS licenses, len(l) > 0 AS licensed,
  array_to_string(list_filter(string_split_regex(rest, '[,|]+'), lambda x: x <> ''), ',') AS unread_ids FROM named""" if first else ""
