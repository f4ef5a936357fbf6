"""Licence scan: sparse TF-IDF cosine of headers and licence files to templates, then inheritance along directories.

Every segment of a text that speaks of a licence is compared with templates: notices of one sentence, whole short
licences, and the heads of long ones. A segment is a line; a long line is cut at ends of sentences and comments, and what
is still long, such as minified text, into windows of words around the places that speak. Runs of such segments with
what follows are compared too, as headers and licence files span lines. Document frequencies of the templates' words come
from all segments of all documents; the vocabulary is the templates' own, so its size is bounded.
The best cosine at or above ``least`` names the text's own licence, of the licences whose distinguishing words (name and
version in the GNU family, the terms of Creative Commons) the text has; an SPDX line of one licence names it outright. A file named like a licence, or one that holds
little else, is a licence file of its directory; a file without a licence of its own takes that of the nearest directory
above it that has a licence file. Directories, not files, are joined with their ancestors.

Defined results: a null text, or one without a licence, has no licence of its own; an SPDX expression of several licences
names none, other notices of several licences that of the best cosine; a null path belongs to no directory
and inherits nothing; equal cosines go to the first template in order; licence files of one directory that differ give
the one of the highest cosine, then the first in order; rows that repeat are scanned one by one; an empty table gives
no rows. Other columns are ignored.
"""

from __future__ import annotations

import bisect
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioframe.scratch import Scratch

# How texts commonly state each licence.
_WARRANTY = "THE SOFTWARE IS PROVIDED AS IS AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
_BSD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
_VERBATIM = "Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed."
_LATER = "This {} is free software; you can redistribute it and/or modify it under the terms of the GNU {}General Public License as published by the Free Software Foundation, either version {} of the License, or (at your option) any later version."
TEMPLATES = {
    "MIT": [
        "Released under the MIT License.", "Licensed under the MIT license.", "licensed under the terms of the MIT license",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction",
        "MIT License Copyright (c) Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
        "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION",
    ],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; version 2",
        _LATER.format("program", "", "2"),
        "Licensed under the GNU General Public License version 2", "Licensed under the GNU General Public License version 2.0",
        f"GNU GENERAL PUBLIC LICENSE Version 2, June 1991 Copyright (C) 1989, 1991 Free Software Foundation, Inc. {_VERBATIM}",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        _LATER.format("program", "", "3"),
        "Licensed under the GNU General Public License version 3", "Licensed under the GNU General Public License version 3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License",
        f"GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc. {_VERBATIM}",
    ],
    "LGPL-2.1": [
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        _LATER.format("library", "Lesser ", "2.1"),
        f"GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999 Copyright (C) 1991, 1999 Free Software Foundation, Inc. {_VERBATIM}",
    ],
    "LGPL-3.0": ["Licensed under the GNU Lesser General Public License, version 3.", _LATER.format("library", "Lesser ", "3"), f"GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc. {_VERBATIM}"],
    "AGPL-3.0": ["Licensed under the GNU Affero General Public License, version 3.", _LATER.format("program", "Affero ", "3"), f"GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007 Copyright (C) 2007 Free Software Foundation, Inc. {_VERBATIM}"],
    "BSD-2-Clause": ["Licensed under the BSD 2-Clause License.", f"BSD 2-Clause License Copyright (c) All rights reserved. {_BSD}"],
    "BSD-3-Clause": [
        "Licensed under the BSD 3-Clause License.",
        f"BSD 3-Clause License Copyright (c) All rights reserved. {_BSD} 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "Licensed under the Mozilla Public License, version 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
        "Mozilla Public License Version 2.0 1. Definitions 1.1. Contributor means each individual or legal entity that creates, contributes to the creation of, or owns Covered Software.",
    ],
    "EPL-2.0": ["Licensed under the Eclipse Public License, version 2.0.", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0"],
    "BSL-1.0": ["Distributed under the Boost Software License, Version 1.0."],
    "ISC": [
        "Licensed under the ISC License.", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
        f"ISC License Copyright (c) Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. {_WARRANTY}",
    ],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain.",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ],
    "CC0-1.0": ["Dedicated to the public domain under CC0 1.0.", "Creative Commons Legal Code CC0 1.0 Universal"],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC-BY-NC-SA-4.0": ["Licensed under CC BY-NC-SA 4.0."],
    "CC-BY-ND-4.0": ["Licensed under CC BY-ND 4.0."],
}
# The words by which licences of one family differ, over a text's tokens. A licence is named only by a text
# that has those of its own; in the family of the GNU licences a version is the number after one of these words.
LESSER, AFFERO = r"(?:lesser|library) general public|lgplv?", r"affero general public|agplv?"
VERSION = r"(?:version|v|license|[al]?gplv?) "
SHARED = {"GPL-2.0": ("", "2"), "GPL-3.0": ("", "3"), "LGPL-2.1": ("L", "2.1"), "LGPL-3.0": ("L", "3"), "AGPL-3.0": ("A", "3")}
COMMONS = re.compile(r"(?<!\S)(?:by|attribution)((?: (?:nc|nd|sa|noncommercial|noderivatives|sharealike|non commercial|no derivatives|share alike))*) 4\.0")
COMMONS_WORDS = {"noncommercial": "nc", "non commercial": "nc", "noderivatives": "nd", "no derivatives": "nd", "sharealike": "sa", "share alike": "sa"}
SPDX = re.compile(r"SPDX-License-Identifier:\s*\(?([A-Za-z0-9.+-]+)\)?(\s+(?:OR|AND|WITH)\b)?")
SPEAKS = r"(?i)licen[sc]|permission (?:is|to use)|redistribution and use|public domain|free software|legal code"
FILE_NAME = r"(?i)(?:^|/)(?:licen[sc]e|copying|notice|unlicense)(?:\.[a-z]+)?$"
WORD = re.compile(r"[a-z]+|[0-9]+(?:\.[0-9]+)*")
_SHORT_VERSION = re.compile(r"\bv\.? ?(?=[0-9])")
RUN = 24  # segments that a header or the head of a licence file may span
RUN_WORDS = 200  # a run goes on up to so many words
LONG = 400  # characters of a line that is cut further
CUT = r"(?<=[.!?|;])\s+|/\*|\*/|//|<!--|-->|[{}]"
AROUND, SPANS = 6, (6, 8, 10, 14, 20, 32, 64, 128)  # windows of a long segment: from so many words before a hit, of so many words


def tokens(text: str) -> list[str]:
    return WORD.findall(_SHORT_VERSION.sub("version ", text.lower().replace("licence", "license")))


_VERSIONS = {v: re.compile(rf"(?<!\S){VERSION}{re.escape(v)}(?:\.0)?(?!\S)") for v in ("2", "2.1", "3")}
_LESSER, _AFFERO = re.compile(rf"(?<!\S)(?:{LESSER})(?!\S)"), re.compile(rf"(?<!\S)(?:{AFFERO})(?!\S)")


def agrees(name: str, words: str) -> bool:
    """Whether a text, as its tokens with spaces between, has the words by which a licence differs from its family."""
    if name in SHARED:
        family, version = SHARED[name]
        own = "A" if _AFFERO.search(words) else "L" if _LESSER.search(words) else ""
        return own == family and bool(_VERSIONS[version].search(words))
    if name.startswith("CC-BY") and (m := COMMONS.search(words)):
        said = m[1]
        for long, short in COMMONS_WORDS.items():
            said = said.replace(long, short)
        return sorted(said.split()) == sorted(x for x in name.lower().split("-") if x in ("nc", "nd", "sa"))
    return True


def declared(line: str) -> str | None:
    """The licence of an SPDX line, if it is one that has templates and stands alone; "-only", "-or-later" and "+" are of
    the same licence. An expression of several names none."""
    m = SPDX.search(line)
    name = re.sub(r"(?:-only|-or-later|\+)$", "", m[1]) if m and not m[2] else None
    return name if name in TEMPLATES else None


class Index:
    """Unit vectors of the templates over their own vocabulary."""

    def __init__(self, documents: float = 0, frequencies: dict[str, float] | None = None):
        self.names = [n for n, texts in TEMPLATES.items() for _ in texts]
        counts = [Counter(tokens(t)) for texts in TEMPLATES.values() for t in texts]
        self.vocabulary = {w: k for k, w in enumerate(sorted({w for c in counts for w in c}))}
        own = Counter(w for c in counts for w in c)
        # Frequencies in the corpus are damped to the templates' number, as most texts state the same few licences.
        share = {w: (frequencies or {}).get(w, 0.0) / documents if documents else 0.0 for w in self.vocabulary}
        self.idf = np.array([math.log((2 + 2 * len(counts)) / (1 + own[w] + share[w] * len(counts))) for w in self.vocabulary])
        self.unknown = math.log(2 + 2 * len(counts)) / 2
        # Each word's templates with its part of their unit vectors.
        self.postings: dict[str, list[tuple[int, float]]] = {w: [] for w in self.vocabulary}
        for k, c in enumerate(counts):
            norm = math.sqrt(sum((n * self.idf[self.vocabulary[w]]) ** 2 for w, n in c.items()))
            for w, n in c.items():
                self.postings[w].append((k, n * self.idf[self.vocabulary[w]] / norm))

    def best(self, words: list[str]) -> tuple[str | None, float]:
        """The licence of the largest cosine of those that the text's own words agree with; words that no template has
        lengthen the text's vector."""
        square, cosines = 0.0, [0.0] * len(self.names)
        for w, n in Counter(words).items():
            k = self.vocabulary.get(w)
            x = n * (self.unknown if k is None else self.idf[k])
            square += x * x
            for t, y in self.postings.get(w, ()):
                cosines[t] += x * y
        if not square:
            return None, 0.0
        joined, asked = " ".join(words), {}
        for at in sorted(range(len(cosines)), key=lambda k: -cosines[k]):
            name = self.names[at]
            if cosines[at] <= 0:
                break
            if name not in asked:
                asked[name] = agrees(name, joined)
            if asked[name]:
                return name, cosines[at] / math.sqrt(square)
        return None, 0.0


def segments(text: Column) -> Column:
    """The lines of a text that speaks of a licence anywhere, long ones cut, without those that are blank."""
    lines = F.flatten(F.transform(F.split(text, r"\n"), lambda l: F.when(F.length(l) <= LONG, F.array(l)).otherwise(F.split(l, CUT))))
    return F.when(text.rlike(SPEAKS), F.filter(lines, lambda l: l.rlike(r"\S")))


def candidates(lines: list[str], speaks: re.Pattern) -> Iterator[tuple[bool, list[str]]]:
    """(one segment, words) of what is compared: each segment that speaks, the runs that begin there, and of long
    segments the windows around the places that speak."""
    for k, line in enumerate(lines):
        hits = [m.start() for m in speaks.finditer(line)]
        if not hits:
            continue
        if len(line) > LONG:
            at = [m.start() for m in WORD.finditer(line.lower())]
            words = tokens(line) if len(at) <= SPANS[-1] else []
            if words:
                yield True, words
            for h in hits:
                first = bisect.bisect_left(at, h)
                for a in range(max(0, first - AROUND), first + 1):
                    for n in SPANS:
                        if a + n // 2 <= len(at):
                            yield False, tokens(line[at[a] : at[a + n] if a + n < len(at) else len(line)])
            continue
        words = tokens(line)
        yield True, words
        run = list(words)
        for more in lines[k + 1 : k + RUN]:
            run = run + tokens(more[: 16 * RUN_WORDS])
            if len(run) > RUN_WORDS:
                break
            yield False, run


def _scan(index: Index, least: float):
    speaks = re.compile(SPEAKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores, parts = [], [], []
            for lines in batch.column(batch.num_columns - 1).to_pylist():
                name, score, words = None, 0.0, 0
                for line in lines or []:
                    if stated := declared(line):
                        words += len(tokens(line))
                        if score < 1.0:
                            name, score = stated, 1.0
                for single, c in candidates(lines or [], speaks):
                    found, s = index.best(c)
                    if s > score + 1e-12:
                        name, score = found, s
                    if s >= least:
                        # Words told: those of the segments that state a licence, or of the longest run that does.
                        words = words + len(c) if single else max(words, len(c))
                names.append(name if score >= least else None)
                scores.append(score)
                parts.append(words)
            kept = batch.columns[:-1]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(parts, pa.int64())], names=[*batch.schema.names[:-1], "licence", "score", "matched"])

    return run


def scan(spark: SparkSession, files: DataFrame, *, id_col: str, path: Column, text_col: str, least: float = 0.7) -> DataFrame:
    """Per row: id, path, licence (own), score, source ('own', 'inherited' or null) and directory (of the licence file)."""
    scratch = Scratch(spark, "licenses")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = files.select(F.col(id_col).alias("id"), path.alias("path"), text.alias("text")).select("id", "path", F.regexp_count("text", F.lit(r"\S+")).cast("long").alias("words"), segments(F.col("text")).alias("lines"))
    vocabulary = list(Index().vocabulary)
    spoken = rows.where("lines is not null").select(F.explode(F.filter("lines", lambda l: l.rlike(SPEAKS))).alias("line"))
    words = F.array_distinct(F.regexp_extract_all(F.replace(F.lower("line"), F.lit("licence"), F.lit("license")), F.lit(r"[a-z]+|[0-9]+(?:\.[0-9]+)*"), F.lit(0)))
    counted = spoken.select(F.explode(F.array_append(words, F.lit(""))).alias("w")).where(F.col("w").isin(["", *vocabulary])).groupBy("w").count().collect()
    frequencies = {r["w"]: float(r["count"]) for r in counted}
    index = Index(frequencies.pop("", 0.0), frequencies)
    found = scratch.save(rows.mapInArrow(_scan(index, least), f"id {files.schema[id_col].dataType.simpleString()}, path string, words long, licence string, score double, matched long"))
    found = found.withColumn("directory", F.when(F.col("path").contains("/"), F.regexp_extract("path", r"^(.*)/[^/]*$", 1)).when(F.col("path").isNotNull(), F.lit("")))
    is_file = F.col("licence").isNotNull() & (F.col("path").rlike(FILE_NAME) | (F.col("matched") * 2 >= F.col("words")))
    best = F.struct((-F.col("score")).alias("far"), F.col("licence"))
    held = found.where(is_file & F.col("directory").isNotNull()).groupBy("directory").agg(F.min(best).alias("b")).select(F.col("directory").alias("from"), F.col("b.licence").alias("given"), (-F.col("b.far")).alias("given_score"))
    parts = F.split("directory", "/")
    ancestors = F.array_append(F.transform(F.sequence(F.size(parts), F.lit(1), F.lit(-1)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/")), F.lit(""))
    places = found.where("licence is null and directory is not null").select("directory").distinct().select("directory", F.posexplode(ancestors).alias("up", "from"))
    nearest = places.join(held, "from").groupBy("directory").agg(F.min_by(F.struct("from", "given", "given_score"), "up").alias("g"))
    out = found.join(nearest, "directory", "left")
    own = F.col("licence").isNotNull()
    return out.select(
        "id",
        "path",
        F.coalesce("licence", "g.given").alias("licence"),
        F.when(own, F.col("score")).otherwise(F.col("g.given_score")).alias("score"),
        F.when(own, "own").when(F.col("g").isNotNull(), "inherited").alias("origin"),
        F.when(~own, F.col("g.from")).alias("licence_directory"),
    )


def document_path() -> Column:
    """Documents have no path: each counts as a file of a directory of fifty in its source's tree, but the first of fifty
    lies in the directory above, the first of a thousand in that of the source, so that there is much to inherit."""
    fifty = F.when(F.expr("doc_id % 50 <> 0"), F.expr("doc_id div 50").cast("string"))
    thousand = F.when(F.expr("doc_id % 1000 <> 0"), F.expr("doc_id div 1000").cast("string"))
    return F.when(F.col("doc_id").isNotNull(), F.concat_ws("/", F.coalesce("source", F.lit("-")), thousand, fifty, F.col("doc_id").cast("string")))


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), id_col="doc_id", path=document_path(), text_col="text").withColumnRenamed("id", "doc_id")
