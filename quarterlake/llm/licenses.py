"""License scans: sparse TF-IDF cosine of windows of terms to license wordings, then inheritance from the nearest ancestor directory.
DataFrame functions only."""

from __future__ import annotations

import json
import math
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterlake.llm.common import table

# Short notices of public licenses.
TEMPLATES = {
    "AGPL-3.0": "This program is licensed under the GNU Affero General Public License, version 3",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "BSD-2-Clause": "Licensed under the BSD 2-Clause Simplified License",
    "BSD-3-Clause": "Licensed under the BSD 3-Clause New or Revised License",
    "CC-BY-4.0": "Licensed under the Creative Commons Attribution License CC BY 4.0",
    "CC-BY-NC-4.0": "Licensed under the Creative Commons NonCommercial License CC BY-NC 4.0",
    "CC-BY-SA-4.0": "Licensed under the Creative Commons ShareAlike License CC BY-SA 4.0",
    "CC0-1.0": "Dedicated to the public domain under the Creative Commons CC0 1.0 Universal license",
    "EPL-2.0": "Licensed under the Eclipse Public License, version 2.0",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "ISC": "Released under the ISC License",
    "LGPL-3.0": "Licensed under the GNU Lesser General Public License, version 3",
    "MIT": "Released under the MIT License",
    "MPL-2.0": "Subject to the terms of the Mozilla Public License, version 2.0",
    "Unlicense": "This is free and unencumbered software released into the public domain under the Unlicense",
}
#: Words as near as this to a wording are a notice.
COSINE = 0.6
#: A document is its directory's license file if at least this share of its words is in notices, or by its name.
FILE_SHARE = 0.1
FILE_NAME = r"(?i)^(un)?licen[cs]e|^copying|^notice"
TERM_GAP = r"[^a-z0-9]+"


def _terms(text: str) -> list[str]:
    return [t for t in re.split(TERM_GAP, text.lower()) if t]


#: Other wordings of the same licenses.
SHORT = [
    ("AGPL-3.0", "Licensed under AGPL 3.0"),
    ("Apache-2.0", "Licensed under Apache 2.0"),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License"),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-4.0", "Creative Commons Attribution 4.0 International License"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-NC-4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC-BY-SA-4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("CC0-1.0", "Licensed under CC0 1.0"),
    ("EPL-2.0", "Licensed under EPL 2.0"),
    ("GPL-2.0", "Licensed under GPL 2.0"),
    ("GPL-3.0", "Licensed under GPL 3.0"),
    ("ISC", "Licensed under the ISC License"),
    ("LGPL-3.0", "Licensed under LGPL 3.0"),
    ("MIT", "Licensed under the MIT License"),
    ("MPL-2.0", "Licensed under MPL 2.0"),
    ("Unlicense", "Released under the Unlicense"),
]
#: Reservations, and titles and passages by which whole license texts are known; the rest of those texts is not compared.
PASSAGES = [
    ("AGPL-3.0", "GNU Affero General Public License Version 3, 19 November 2007"),
    ("AGPL-3.0", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("All-Rights-Reserved", "All rights reserved"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("CC-BY-4.0", "Creative Commons Attribution 4.0 International Public License"),
    ("CC-BY-NC-4.0", "Creative Commons Attribution-NonCommercial 4.0 International Public License"),
    ("CC-BY-NC-ND-4.0", "Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International Public License"),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0"),
    ("CC-BY-NC-SA-4.0", "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International Public License"),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0"),
    ("CC-BY-ND-4.0", "Creative Commons Attribution-NoDerivatives 4.0 International Public License"),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0"),
    ("CC-BY-SA-4.0", "Creative Commons Attribution-ShareAlike 4.0 International Public License"),
    ("CC0-1.0", "Creative Commons Legal Code CC0 1.0 Universal"),
    ("EPL-2.0", "Eclipse Public License - v 2.0"),
    ("GPL-2.0", "GNU General Public License Version 2, June 1991"),
    ("GPL-2.0", "under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License"),
    ("GPL-3.0", "GNU General Public License Version 3, 29 June 2007"),
    ("GPL-3.0", "under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("LGPL-3.0", "GNU Lesser General Public License Version 3, 29 June 2007"),
    ("LGPL-3.0", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("Unlicense", "This is free and unencumbered software released into the public domain"),
]
SPDX = [(name, f"SPDX-License-Identifier: {name}{end}") for name in sorted({n for n, _ in [*SHORT, *PASSAGES]} - {"All-Rights-Reserved"}) for end in (("", "-only", "-or-later") if "GPL" in name else ("",))]
WORDINGS = [*TEMPLATES.items(), *SHORT, *PASSAGES, *SPDX]
#: Windows are laid so that one of these terms is where a wording has it, or one place off.
ANCHORS = ("license", "licensed", "domain", "unlicense", "reserved", "spdx", "cc0", "granted", "redistribution", "endorse")
#: idf = ln((licenses + 1) / (licenses with the term + 1)) + 1, over the wordings: a verdict depends on the text alone, not on the table.
_NAMES = {name for name, _ in WORDINGS}
_HOLD = {t: {n for n, y in WORDINGS if t in _terms(y)} for _, x in WORDINGS for t in _terms(x)}
IDF = {t: math.log((len(_NAMES) + 1) / (len(n) + 1)) + 1 for t, n in sorted(_HOLD.items())}
OTHER_IDF = math.log(len(_NAMES) + 1) + 1
REACH = max(len(_terms(x)) for _, x in WORDINGS)


def terms_of(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), TERM_GAP), "")


def _is_cue(text: Column) -> Column:
    low = F.lower(text)
    out = low.contains(ANCHORS[0])
    for anchor in ANCHORS[1:]:
        out = out | low.contains(anchor)
    return out


def wordings(spark: SparkSession) -> DataFrame:
    """(anchor, at, name, n_terms, weights): each anchor of each wording, its place, and the unit TF-IDF vector of the wording."""
    rows = []
    for name, text in WORDINGS:
        terms = _terms(text)
        w = {t: terms.count(t) * IDF[t] for t in terms}
        norm = math.sqrt(sum(x * x for x in w.values()))
        rows += [{"anchor": t, "at": at, "name": name, "n_terms": len(terms), "weights": {k: x / norm for k, x in w.items()}} for at, t in enumerate(terms) if t in ANCHORS]
    kind = "array<struct<anchor:string,at:int,name:string,n_terms:int,weights:map<string,double>>>"
    return spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), kind)))


def windows(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, said, place, begin, stop, name, n_terms, cosine) of the windows of terms that come near to a wording, each as long as the
    wording; line ends do not matter. Terms of no wording weigh as much as the rarest."""
    idf = F.create_map(*(F.lit(x) for pair in IDF.items() for x in pair))
    some = docs.where(_is_cue(F.col(text))).select(F.col(key).alias("doc_id"), F.xxhash64(text).alias("said"), terms_of(F.col(text)).alias("terms"))
    places = F.filter(F.transform("terms", lambda t, i: F.when(t.isin(*ANCHORS), i)), lambda i: i.isNotNull())
    at = some.select("doc_id", "said", "terms", F.explode(places).alias("place")).withColumn("first", F.greatest(F.col("place") - REACH, F.lit(0)))
    near = at.select("doc_id", "said", "place", "first", F.slice("terms", F.col("first") + 1, F.lit(2 * REACH + 1)).alias("around"))
    near = near.select("doc_id", "said", "place", "first", F.element_at("around", F.col("place") - F.col("first") + 1).alias("anchor"), F.transform("around", lambda t: F.struct(t.alias("t"), F.coalesce(idf[t], F.lit(OTHER_IDF)).alias("idf"))).alias("around"))
    laid = near.join(F.broadcast(wordings(docs.sparkSession)), "anchor").withColumn("off", F.explode(F.array(*(F.lit(i) for i in (-1, 0, 1)))))
    laid = laid.withColumn("begin", F.col("place") - F.col("at") + F.col("off")).where(F.col("begin") >= F.col("first"))
    laid = laid.select("doc_id", "said", "place", "begin", "name", "n_terms", "weights", F.slice("around", F.col("begin") - F.col("first") + 1, F.col("n_terms")).alias("window")).where(F.size("window") > 0)
    dot = F.aggregate("window", F.lit(0.0), lambda a, x: a + x["idf"] * F.coalesce(F.col("weights")[x["t"]], F.lit(0.0)))
    square = F.aggregate("window", F.lit(0.0), lambda a, x: a + x["idf"] * x["idf"] * F.size(F.filter("window", lambda y: y["t"] == x["t"])))
    stop = (F.col("begin") + F.size("window")).alias("stop")
    return laid.select("doc_id", "said", "place", "begin", stop, "name", "n_terms", F.round(dot / F.sqrt(square), 9).alias("cosine")).where(F.col("cosine") >= COSINE)


def notices(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, own_license, cosine, notice_words) of documents with a notice: the wording nearest to any window (ties: the longer
    wording, the earlier window, the name) and the words in the best windows of all anchors."""
    rank = F.struct((-F.col("cosine")).alias("c"), (-F.col("n_terms")).alias("l"), "begin", "name", "stop")
    near = windows(docs, text, key).groupBy("doc_id", "said", "place").agg(F.min(rank).alias("best"))
    words = near.select("doc_id", "said", "best", F.explode(F.sequence("best.begin", F.col("best.stop") - 1)).alias("word")).groupBy("doc_id", "said", "word").agg(F.min("best").alias("best"))
    return words.groupBy("doc_id").agg(F.min("best").alias("best"), F.count(F.lit(1)).alias("notice_words")).select("doc_id", F.col("best.name").alias("own_license"), (-F.col("best.c")).alias("cosine"), "notice_words")


def scan_licenses(docs: DataFrame, path: Column, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, path, own_license, cosine, is_license_file, license, license_dir) of every row.

    A document has its own notice's license, else that of the nearest ancestor directory with a license file (of several files the
    first path counts), else none. Only directories and documents with notices are grouped, never a directory's documents.

    Defined results: null or empty texts have no notice; a null path inherits nothing and is no license file; a null id is one more id;
    rows of one id share their notices; an empty table gives an empty table; other columns are ignored.
    """
    docs = docs.select(F.col(key).alias("doc_id"), path.alias("path"), F.col(text).alias("text"))
    found = notices(docs)
    small = docs.select("doc_id", "path", F.when(_is_cue(F.col("text")), F.size(terms_of(F.col("text")))).alias("n_words"))
    held = small.join(found.withColumnRenamed("doc_id", "found_id"), F.col("doc_id").eqNullSafe(F.col("found_id")), "left").drop("found_id")
    held = held.withColumn("dir", F.when(F.col("path").contains("/"), F.regexp_replace("path", "/[^/]*$", "")).when(F.col("path").isNotNull(), F.lit("")))
    by_name = F.regexp_replace("path", "^.*/", "").rlike(FILE_NAME)
    by_share = F.col("notice_words") >= FILE_SHARE * F.col("n_words")
    held = held.withColumn("is_license_file", F.coalesce(F.col("own_license").isNotNull() & F.col("path").isNotNull() & (by_name | by_share), F.lit(False)))
    files = held.where("is_license_file").groupBy("dir").agg(F.min(F.struct("path", "own_license")).alias("f")).select(F.col("dir").alias("license_dir"), F.col("f.own_license").alias("inherited"))
    parts = F.split("dir", "/")
    above = F.concat(F.array(F.lit("")), F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, F.lit(1), k), "/")))
    dirs = held.where("dir IS NOT NULL").select("dir").distinct().select("dir", F.explode(F.array_distinct(above)).alias("license_dir"))
    near = dirs.join(files, "license_dir").groupBy("dir").agg(F.max(F.struct(F.length("license_dir").alias("depth"), "license_dir", "inherited")).alias("n")).select("dir", "n.license_dir", "n.inherited")
    out = held.join(near, "dir", "left")
    own = F.col("own_license").isNotNull()
    return out.select("doc_id", "path", "own_license", "cosine", "is_license_file", F.coalesce("own_license", "inherited").alias("license"), F.when(~own, F.col("license_dir")).alias("license_dir"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    path = F.concat_ws("/", "source", "lang", F.floor(F.col("doc_id") / 64).cast("string"), F.col("doc_id").cast("string"))
    return scan_licenses(docs, path).withColumn("cosine", F.round("cosine", 6))


def _wording_rows() -> str:
    return ", ".join(f"({k}, '{name}', {len(_terms(text))}, '{t}', {at})" for k, (name, text) in enumerate(WORDINGS) for at, t in enumerate(_terms(text)))


_CUE_SQL = " OR ".join(f"contains(lower(text), '{anchor}')" for anchor in ANCHORS)
_ANCHORS_SQL = ", ".join(f"'{a}'" for a in ANCHORS)
_IDF_SQL = ", ".join(f"('{t}', {x!r}::DOUBLE)" for t, x in IDF.items())

OP9_SQL = f"""
WITH given(wording, name, n_terms, term, spot) AS (VALUES {_wording_rows()}),
idfs(term, idf) AS (VALUES {_IDF_SQL}),
weights AS (
  SELECT wording, term, count(*) * any_value(idf) / any_value(norm) AS weight
  FROM given JOIN idfs USING (term) JOIN (
    SELECT wording, sqrt(sum((c * idf) ** 2)) AS norm FROM (SELECT wording, term, count(*) AS c FROM given GROUP BY ALL) JOIN idfs USING (term) GROUP BY 1) USING (wording)
  GROUP BY 1, 2),
docs AS (
  SELECT doc_id, concat_ws('/', source, lang, (doc_id // 64)::VARCHAR, doc_id::VARCHAR) AS path, coalesce(text, '') AS text,
    list_filter(string_split_regex(lower(coalesce(text, '')), '{TERM_GAP}'), lambda x: x <> '') AS terms
  FROM documents),
cued AS (SELECT DISTINCT doc_id, md5(text) AS said, terms FROM docs WHERE {_CUE_SQL}),
places AS (SELECT * FROM (SELECT doc_id, said, terms, unnest(terms) AS anchor, generate_subscripts(terms, 1) - 1 AS place FROM cued) WHERE anchor IN ({_ANCHORS_SQL})),
laid AS (
  SELECT row_number() OVER () AS id, doc_id, said, place, wording, name, n_terms, place - spot + shift AS begin, terms[place - spot + shift + 1 : place - spot + shift + n_terms] AS win
  FROM places JOIN given ON given.term = anchor, (VALUES (-1), (0), (1)) o(shift)
  WHERE place - spot + shift >= greatest(place - {REACH}, 0)),
parts AS (SELECT id, any_value(wording) AS wording, term, count(*) AS tf FROM (SELECT id, wording, unnest(win) AS term FROM laid) GROUP BY id, term),
scored AS (
  SELECT id, round(sum(tf * coalesce(idf, {OTHER_IDF!r}) * coalesce(weight, 0)) / sqrt(sum((tf * coalesce(idf, {OTHER_IDF!r})) ** 2)), 9) AS cosine
  FROM parts LEFT JOIN idfs USING (term) LEFT JOIN weights USING (wording, term) GROUP BY 1),
near AS (
  SELECT doc_id, said, place, min(row(-cosine, -n_terms, begin, name, begin + len(win))) AS best
  FROM laid JOIN scored USING (id) WHERE cosine >= {COSINE} GROUP BY 1, 2, 3),
covered AS (
  SELECT doc_id, said, word, min(best) AS best
  FROM (SELECT doc_id, said, best, unnest(range(best[3]::BIGINT, best[5]::BIGINT)) AS word FROM near) GROUP BY 1, 2, 3),
found AS (SELECT doc_id, min(best)[4] AS own_license, -min(best)[1] AS cosine, count(*) AS notice_words FROM covered GROUP BY 1),
held AS (
  SELECT d.doc_id, d.path, regexp_replace(d.path, '/[^/]*$', '') AS dir, own_license, cosine,
    coalesce(own_license IS NOT NULL AND (regexp_matches(regexp_replace(d.path, '^.*/', ''), '{FILE_NAME}')
      OR notice_words >= {FILE_SHARE} * len(d.terms)), false) AS is_license_file
  FROM docs d LEFT JOIN found ON found.doc_id IS NOT DISTINCT FROM d.doc_id),
files AS (SELECT dir AS license_dir, arg_min(own_license, path) AS inherited FROM held WHERE is_license_file GROUP BY 1),
dirs AS (SELECT DISTINCT dir, string_split(dir, '/') AS parts FROM held),
over_dirs AS (SELECT dir, array_to_string(parts[1:k], '/') AS license_dir FROM dirs, range(0, 20) t(k) WHERE k <= len(parts)),
nearest AS (SELECT dir, arg_max({{'d': a.license_dir, 'l': inherited}}, length(a.license_dir)) AS n FROM over_dirs a JOIN files USING (license_dir) GROUP BY 1)
SELECT doc_id, path, own_license, round(cosine, 6) AS cosine, is_license_file, coalesce(own_license, n.l) AS license,
  CASE WHEN own_license IS NULL THEN n.d END AS license_dir
FROM held LEFT JOIN nearest USING (dir)
"""
