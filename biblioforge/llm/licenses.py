"""License scans: TF-IDF cosine of headers and licence files to templates, and inheritance along directories (operator 6).

DataFrame operations only. Every line is scored as a header, every block of lines between empty ones as well, and
licence files as a whole. Terms count once per header (binary term frequency) and weigh by their inverse document
frequency in the collection of templates; a term that no template has weighs as one of no template. So a header's score
depends on it and the templates alone, and two conditions that lose nothing tell most headers apart where they are
read: a header within the threshold of a template has one of the template's heaviest terms (those that leave less than
the threshold to the rest), and enough of its terms stand in templates. The rest meet the templates in a join on terms;
equal headers are scored once. A file without a header of its own inherits from the nearest ancestor directory that
holds a licence file.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from biblioforge.llm.common import Scratch

#: Notices, headers and texts of common licences; a licence may have several.
TEMPLATES = {
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT license. See LICENSE file in the project root for full license information.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ],
    "ISC": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "You may not use this file except in compliance with the Apache License.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
        "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/",
    ],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "GNU General Public License Version 2, June 1991",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "GNU General Public License Version 3, 29 June 2007",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "LGPL-3.0": ["Licensed under the GNU Lesser General Public License, version 3.", "GNU Lesser General Public License Version 3, 29 June 2007"],
    "AGPL-3.0": ["Licensed under the GNU Affero General Public License, version 3.", "GNU Affero General Public License Version 3, 19 November 2007"],
    "BSD-2-Clause": ["Redistribution and use are permitted under the BSD 2-Clause License."],
    "BSD-3-Clause": [
        "Redistribution and use are permitted under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    ],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.", "Mozilla Public License Version 2.0"],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "Licensed under Creative Commons Attribution CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC0-1.0": ["Dedicated to the public domain under CC0 1.0 Universal license."],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
}
TOKEN = r"[a-z0-9]+(?:[.\-][a-z0-9]+)*"
MIN_COSINE = 0.5
LICENCE_SHARE = 0.2  # terms of a file's headers over its words from which it speaks for its directory
LICENCE_NAME = r"(?i)(^|/)(licen[cs]e|copying|notice)[^/]*$"


def _tokens(text: Column | str) -> Column:
    """Distinct terms of a text."""
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(f"({TOKEN})"), 1))


class Templates:
    """The terms of each template and their weights."""

    def __init__(self, templates: dict[str, list[str] | str] | None = None, min_cosine: float = MIN_COSINE):
        texts = [(name, t) for name, own in (templates or TEMPLATES).items() for t in ([own] if isinstance(own, str) else own)]
        self.terms = [(name, k, sorted(set(re.findall(TOKEN, t.lower())))) for k, (name, t) in enumerate(texts)]
        in_texts: dict[str, int] = {}
        for _, _, own in self.terms:
            for t in own:
                in_texts[t] = in_texts.get(t, 0) + 1
        self.idf = {t: math.log((1 + len(texts)) / (1 + n)) + 1 for t, n in in_texts.items()}
        self.unknown = math.log(1 + len(texts)) + 1
        self.min_cosine = min_cosine
        self.heavy: set[str] = set()
        for _, _, own in self.terms:
            left = total = sum(self.idf[t] ** 2 for t in own)
            for t in sorted(own, key=lambda t: (-self.idf[t], t)):
                if left < min_cosine**2 * total * (1 - 1e-9):
                    break
                self.heavy.add(t)
                left -= self.idf[t] ** 2

    def may_match(self, tokens: Column) -> Column:
        """False only for terms whose cosine with every template is under the threshold."""
        held = lambda terms: F.size(F.filter(tokens, lambda t: t.isin(sorted(terms))))
        least = self.min_cosine**2 / (1 - self.min_cosine**2) * (1 - 1e-9)  # squares of known weights over those of unknown ones
        by_weight: dict[float, list[str]] = {}
        for t, w in self.idf.items():
            by_weight.setdefault(w, []).append(t)
        squares = sum((held(terms) * w**2 for w, terms in sorted(by_weight.items())), F.lit(0.0))
        unknown = F.size(tokens) - held(self.idf)
        return F.exists(tokens, lambda t: t.isin(sorted(self.heavy))) & (held(self.idf) >= least * unknown) & (squares >= least * unknown * self.unknown**2)

    def frame(self, spark: SparkSession) -> DataFrame:
        """license, template, t, idf, v: a row per term of each template; v is its share of the template's norm."""
        rows = []
        for name, k, own in self.terms:
            norm = math.sqrt(sum(self.idf[t] ** 2 for t in own))
            rows += [(name, k, t, self.idf[t], self.idf[t] / norm) for t in own]
        return spark.createDataFrame(rows, "license string, template int, t string, idf double, v double")


def score_headers(headers: DataFrame, templates: Templates) -> DataFrame:
    """(header, tokens) distinct -> header, license, cosine: the closest template of each header that reaches the threshold.

    Ties go to the licence name that sorts first.
    """
    own = templates.frame(headers.sparkSession)
    terms = headers.select("header", F.size("tokens").alias("size"), F.explode("tokens").alias("t"))
    met = terms.join(F.broadcast(own), "t")  # a row per term of a template: some hundred
    known = terms.join(F.broadcast(own.select("t", "idf").distinct()), "t").groupBy("header").agg(F.first("size").alias("size"), F.count("*").alias("known"), F.sum(F.col("idf") * F.col("idf")).alias("squares"))
    norm = known.select("header", F.sqrt(F.col("squares") + (F.col("size") - F.col("known")) * templates.unknown**2).alias("wn"))
    dot = met.groupBy("header", "license", "template").agg(F.sum(F.col("idf") * F.col("v")).alias("dot"))
    best = dot.join(norm, "header").groupBy("header", "license").agg(F.round(F.max(F.col("dot") / F.col("wn")), 6).alias("cosine")).where(F.col("cosine") >= templates.min_cosine)
    return best.groupBy("header").agg(F.min(F.struct((-F.col("cosine")).alias("less"), "license")).alias("b")).select("header", F.col("b.license").alias("license"), (-F.col("b.less")).alias("cosine"))


def scan_licenses(files: DataFrame, templates: dict[str, list[str] | str] | None = None, min_cosine: float = MIN_COSINE) -> DataFrame:
    """file_id, path, license, cosine, origin ('own', 'inherited' or 'none'), from_dir for every row.

    files: file_id, path, text; other columns are ignored. Null or empty texts have no header; null paths inherit
    nothing and give nothing. Rows that repeat file_id share their headers, each returns a row. An empty table gives none.
    """
    spark = files.sparkSession
    scratch = Scratch(spark, "licenses")
    files = files.select("file_id", F.col("path").cast("string").alias("path"), F.col("text").cast("string").alias("text"))
    known = Templates(templates, min_cosine)
    blocks = F.filter(F.split("text", r"\n[\x20\x09-\x0D]*\n"), lambda x: F.contains(x, F.lit("\n")))
    whole = F.when(F.col("path").rlike(LICENCE_NAME), F.array("text")).otherwise(F.array().cast("array<string>"))
    headers = F.array_distinct(F.concat(F.split("text", "\n"), blocks, whole))
    words = F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+"))
    tokens = F.transform(headers, lambda h: F.struct(h.alias("header"), _tokens(h).alias("tokens")))
    found = files.where("text is not null").select("file_id", "path", F.filter(tokens, lambda x: known.may_match(x.tokens)).alias("headers"), words.alias("words"))
    found = scratch.keep(found.where(F.size("headers") > 0), "headers")
    lines = found.select("file_id", "path", "words", F.explode("headers").alias("h")).select("file_id", "path", "words", "h.header", "h.tokens")
    scored = scratch.keep(score_headers(lines.select("header", "tokens").distinct(), known), "scored")
    hits = lines.select("file_id", "path", "words", "header", F.size("tokens").alias("size")).join(scored, "header")
    own = hits.groupBy("file_id", "path").agg(F.min(F.struct((-F.col("cosine")).alias("less"), "license")).alias("b"), F.sum("size").alias("size"), F.max("words").alias("words"))
    own = own.select("file_id", "path", F.col("b.license").alias("license"), (-F.col("b.less")).alias("cosine"), ((F.col("size") >= LICENCE_SHARE * F.col("words")) | F.col("path").rlike(LICENCE_NAME)).alias("speaks"))
    own = scratch.keep(own, "own")
    folder = F.regexp_replace("path", r"/?[^/]*$", "")
    speaking = own.where("speaks and path is not null").groupBy(folder.alias("dir")).agg(F.min(F.struct((-F.col("cosine")).alias("less"), "path", "license")).alias("b"))
    speaking = speaking.select("dir", F.col("b.license").alias("dir_license"), (-F.col("b.less")).alias("dir_cosine"))
    # Distinct directories with all their ancestors; the deepest ancestor that speaks counts.
    dirs = files.where("path is not null").select(folder.alias("of")).distinct()
    parts = F.split("of", "/")
    chain = dirs.select("of", F.explode(F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.struct(n.alias("depth"), F.array_join(F.slice(parts, 1, n), "/").alias("dir")))).alias("a"))
    near = chain.select("of", F.col("a.depth").alias("depth"), F.col("a.dir").alias("dir")).join(speaking, "dir").groupBy("of").agg(F.max(F.struct("depth", "dir", "dir_license", "dir_cosine")).alias("n"))
    near = near.select("of", F.col("n.dir").alias("dir"), "n.dir_license", "n.dir_cosine")
    mine = own.groupBy("file_id").agg(F.min(F.struct((-F.col("cosine")).alias("less"), "license")).alias("m"))
    out = files.select("file_id", "path", folder.alias("of")).join(mine, "file_id", "left").join(near, "of", "left")
    origin = F.when(F.col("m").isNotNull(), "own").when(F.col("dir_license").isNotNull(), "inherited").otherwise("none")
    return out.select("file_id", "path", F.coalesce("m.license", "dir_license").alias("license"), F.coalesce(-F.col("m.less"), F.col("dir_cosine")).alias("cosine"), origin.alias("origin"), F.when(origin == "inherited", F.col("dir")).alias("from_dir"))


def document_files(docs: DataFrame) -> DataFrame:
    """Documents as files source/lang/doc_id; a null part is '_'."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("_"))
    return docs.select(F.col("doc_id").alias("file_id"), F.concat_ws("/", part("source"), part("lang"), part("doc_id")).alias("path"), "text")
