"""License scans by sentence rules, in DataFrame functions only.

A text is cut into sentences (behind . ! ? ; : before white space, and at blank lines; a sentence that is
not known as a whole is looked at line by line), sentences are normalised (A-Z lower-cased, all else
but a-z and 0-9 one blank) and mapped to the identifiers of known licence sentences.  The sequence of
identifiers is then matched against ordered rules: each rule's run of identifiers becomes its licence,
longer runs first, and what a rule has taken is no longer there for later ones.  Unknown sentences
break a run.

Null and empty texts have no sentences and no licences.  Nothing is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradeloom.llm.common import boxed

#: Known licence sentences, normalised, by identifier (fixed values).
SENTENCES = {
    "AllRights": "all rights reserved",
    "ApacheLic": "licensed under the apache license version 2 0",
    "ApacheLicThe": "licensed under the apache license version 2 0 the license",
    "ApacheMayNot": "you may not use this file except in compliance with the license",
    "ApacheCopyAt": "you may obtain a copy of the license at",
    "ApacheAsIs": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "ApacheSee": "see the license for the specific language governing permissions and limitations under the license",
    "BsdRedist": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "BsdSource": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "BsdBinary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "BsdRef": "released under the bsd license",
    "CcBy": "licensed under cc by 4 0",
    "CcBySa": "licensed under cc by sa 4 0",
    "CcByNc": "licensed under cc by nc 4 0",
    "CcZero": "released under cc0 1 0",
    "Gpl2Ref": "this work is licensed under the gnu general public license version 2",
    "Gpl3Ref": "this work is licensed under the gnu general public license version 3",
    "GplFree3": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "GplHope": "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "GplMore": "see the gnu general public license for more details",
    "MitRef": "released under the mit license",
    "MitLicRef": "licensed under the mit license",
    "MitGrant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "MitNotice": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "MitAsIs": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
}

#: Licence and the run of sentence identifiers that shows it, in the order of matching (fixed values).
RULES = [
    ("Apache-2.0", "ApacheLicThe ApacheMayNot ApacheCopyAt ApacheAsIs ApacheSee"),
    ("Apache-2.0", "ApacheLicThe ApacheMayNot ApacheCopyAt"),
    ("GPL-3.0-or-later", "GplFree3 GplHope GplMore"),
    ("MIT", "MitGrant MitNotice MitAsIs"),
    ("BSD-2-Clause", "BsdRedist BsdSource BsdBinary"),
    ("MIT", "MitGrant MitNotice"),
    ("GPL-3.0-or-later", "GplFree3"),
    ("Apache-2.0", "ApacheLicThe"),
    ("Apache-2.0", "ApacheLic"),
    ("GPL-2.0", "Gpl2Ref"),
    ("GPL-3.0", "Gpl3Ref"),
    ("MIT", "MitRef"),
    ("MIT", "MitLicRef"),
    ("BSD", "BsdRef"),
    ("CC-BY-4.0", "CcBy"),
    ("CC-BY-SA-4.0", "CcBySa"),
    ("CC-BY-NC-4.0", "CcByNc"),
    ("CC0-1.0", "CcZero"),
    ("All-Rights-Reserved", "AllRights"),
]

#: Every known sentence holds one of these words, so other sentences need not be normalised.
HINTS = ("licens", "reserved", "redistribut", "granted", "copyright", "warrant", "released under")

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
CUT = "\x01"


def normalised(sentence: Column) -> Column:
    return F.trim(F.regexp_replace(F.translate(sentence, UPPER, LOWER), "[^a-z0-9]+", " "))


def _identifier(sentence: Column, known: Column) -> Column:
    """``<identifier>`` of a sentence, null if it's not known."""
    hinted = F.translate(sentence, UPPER, LOWER).rlike("|".join(h.replace(" ", "[^a-z0-9]+") for h in HINTS))
    return F.when(hinted, F.try_element_at(known, normalised(sentence)))


def identified(text: Column, sentences: dict[str, str] | None = None) -> Column:
    """The text's sentences as a string of ``<identifier>``, a run of unknown ones as ``_``."""
    sentences = sentences or SENTENCES
    if missed := [i for i, s in sentences.items() if not any(h in s for h in HINTS)]:
        raise ValueError(f"sentences without a hint word: {missed}")
    known = F.create_map(*(F.lit(x) for i, s in sentences.items() for x in (s, f"<{i}>")))
    cut = F.split(F.regexp_replace(F.regexp_replace(text, r"([.!?;:])\s+", "$1" + CUT), r"\n\s*\n", CUT), CUT)

    def units(sentence: Column) -> Column:
        whole = _identifier(sentence, known)
        lines = F.transform(F.split(sentence, "\n"), lambda line: F.coalesce(_identifier(line, known), F.lit("_")))
        return F.when(~sentence.contains("\n"), F.coalesce(whole, F.lit("_"))).otherwise(F.coalesce(whole, F.array_join(lines, "")))

    return F.regexp_replace(F.array_join(F.transform(cut, units), ""), "_+", "_")


def matched(identifiers: Column, rules: list[tuple[str, str]] | None = None) -> Column:
    """The string of identifiers with every rule's runs, rule by rule, turned into ``{licence}``."""
    for licence, run in rules or RULES:
        identifiers = F.replace(identifiers, F.lit("".join(f"<{i}>" for i in run.split())), F.lit(f"{{{licence}}}"))
    return identifiers


def scan(documents: DataFrame) -> DataFrame:
    """``documents`` with ``sentences`` (identifiers in order), ``licenses`` (distinct, sorted) and ``n_licenses``."""
    # a text without any hint has no known sentence
    hinted = F.translate(F.col("text"), UPPER, LOWER).rlike("|".join(h.replace(" ", "[^a-z0-9]+") for h in HINTS))
    marks = F.coalesce(F.when(hinted, identified(F.col("text"))), F.lit(""))
    found = F.array_sort(F.array_distinct(F.regexp_extract_all(F.col("_m"), F.lit(r"\{([^}]*)\}"), 1)))
    work = documents.select(boxed(documents, "sentences", "licenses", "n_licenses").alias("_row"), marks.alias("_s"))
    return (work.withColumn("_m", matched(F.col("_s")))
            .select("_row.*", F.array_join(F.regexp_extract_all("_s", F.lit("<([^>]*)>"), 1), " ").alias("sentences"),
                    F.array_join(found, ",").alias("licenses"), F.size(found).alias("n_licenses")))


def oracle() -> str:
    """The scan in DuckDB's SQL, from the same tables."""
    def text(value: str) -> str:
        return "'" + value.replace("'", "''") + "'"

    def ident(x: str) -> str:
        low = f"trim(regexp_replace(translate({x}, '{UPPER}', '{LOWER}'), '[^a-z0-9]+', ' ', 'g'))"
        return f"(SELECT '<' || id || '>' FROM known WHERE known.sentence = {low})"

    marks = "s"
    for licence, run in RULES:
        marks = f"replace({marks}, {text(''.join(f'<{i}>' for i in run.split()))}, {text('{' + licence + '}')})"
    known = ", ".join(f"({text(i)}, {text(s)})" for i, s in SENTENCES.items())
    return f"""
    WITH known(id, sentence) AS (VALUES {known}),
    cut AS (SELECT doc_id, string_split(regexp_replace(regexp_replace(text, '([.!?;:])\\s+', '\\1' || chr(1), 'g'), '\\n\\s*\\n', chr(1), 'g'), chr(1)) AS parts FROM documents),
    sentence AS (SELECT doc_id, unnest(parts) AS whole, unnest(range(len(parts))) AS k FROM cut),
    named AS (SELECT doc_id, k, whole, {ident('whole')} AS id FROM sentence),
    line AS (SELECT doc_id, k, unnest(CASE WHEN id IS NULL THEN string_split(whole, chr(10)) ELSE [whole] END) AS unit,
                    unnest(range(CASE WHEN id IS NULL THEN len(string_split(whole, chr(10))) ELSE 1 END)) AS j FROM named),
    marked AS (SELECT doc_id, k, j, coalesce({ident('unit')}, '_') AS mark FROM line),
    joined AS (SELECT d.doc_id, coalesce(regexp_replace(m.s, '_+', '_', 'g'), '') AS s FROM documents d
               LEFT JOIN (SELECT doc_id, string_agg(mark, '' ORDER BY k, j) AS s FROM marked GROUP BY doc_id) m USING (doc_id)),
    done AS (SELECT doc_id, s, list_sort(list_distinct(regexp_extract_all({marks}, '\\{{([^}}]*)\\}}', 1))) AS found FROM joined)
    SELECT doc_id, array_to_string(regexp_extract_all(s, '<([^>]*)>', 1), ' ') AS sentences,
           array_to_string(found, ',') AS licenses, CAST(len(found) AS INTEGER) AS n_licenses FROM done"""
