"""Licences of files: TF-IDF cosine of their notices to templates, then inheritance.

A file's own licence is the template nearest to one of its sentences, lines, runs of lines or
paragraphs (comment blocks) that mention licensing, to a window of a long template's length
around a mention, or to the whole text if it is a licence file by name. Weights are
term counts times ln((N + 1) / (df + 1)) + 1 over all N files, with the df of every term
over all files. Notices are first compared with the least weight, 1, for terms of no template;
for those that may still reach the threshold the weights of these terms are joined.
A file without its own takes the licence of the nearest directory above it that has a
licence file: directories are joined with their ancestors' paths, files with directories.
"""

import math
import re
import sys
from collections import Counter

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import functions as F

from tidemark.llm.shared import bounded_batches, slices
from tidemark.sources.shared_folder import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

THRESHOLD = 0.75

#: Notices by licence. Longer texts of the same licences can be added.
TEMPLATES = {
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the \"Software\"), to deal in the Software "
        "without restriction",
        "MIT License Permission is hereby granted, free of charge, to any person "
        "obtaining a copy of this software and associated documentation files (the "
        '"Software"), to deal in the Software without restriction, including without '
        "limitation the rights to use, copy, modify, merge, publish, distribute, "
        "sublicense, and/or sell copies of the Software, and to permit persons to whom "
        "the Software is furnished to do so, subject to the following conditions: The "
        "above copyright notice and this permission notice shall be included in all "
        'copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS '
        'IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED'
        " TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND "
        "NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE "
        "FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, "
        "TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR "
        "THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "SPDX-License-Identifier: Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this "
        "file except in compliance with the License.",
        "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version.",
        "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    ),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        "SPDX-License-Identifier: GPL-2.0-only",
        "GNU GENERAL PUBLIC LICENSE Version 2, June 1991",
        "This program is free software; you can redistribute it and/or modify it under "
        "the terms of the GNU General Public License as published by the Free Software "
        "Foundation; either version 2 of the License, or (at your option) any later "
        "version.",
    ),
    "LGPL-3.0": (
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        "SPDX-License-Identifier: LGPL-3.0-only",
        "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
        "This program is free software: you can redistribute it and/or modify it under "
        "the terms of the GNU Lesser General Public License as published by the Free "
        "Software Foundation, either version 3 of the License, or (at your option) any "
        "later version.",
    ),
    "AGPL-3.0": (
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "SPDX-License-Identifier: AGPL-3.0-only",
        "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007",
        "This program is free software: you can redistribute it and/or modify it under "
        "the terms of the GNU Affero General Public License as published by the Free "
        "Software Foundation, either version 3 of the License, or (at your option) any "
        "later version.",
    ),
    "BSD-3-Clause": (
        "Released under the 3-Clause BSD License.",
        "SPDX-License-Identifier: BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met",
    ),
    "MPL-2.0": (
        "SPDX-License-Identifier: MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ),
    "BSD-2-Clause": (
        "Released under the 2-Clause BSD License.",
        "SPDX-License-Identifier: BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met",
    ),
    "LGPL-2.1": (
        "This work is licensed under the GNU Lesser General Public License, version 2.1.",
        "SPDX-License-Identifier: LGPL-2.1-only",
        "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999",
        "This library is free software; you can redistribute it and/or modify it under "
        "the terms of the GNU Lesser General Public License as published by the Free "
        "Software Foundation; either version 2.1 of the License, or (at your option) any "
        "later version.",
    ),
    "CC0-1.0": ("Licensed under CC0 1.0 Universal.", "SPDX-License-Identifier: CC0-1.0"),
    "Unlicense": ("This is free and unencumbered software released into the public domain.",),
    "ISC": ("Released under the ISC License.", "SPDX-License-Identifier: ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose"
        " with or without fee is hereby granted, provided that the above copyright notice"
        " and this permission notice appear in all copies.",
    ),
}

#: Variants and versions of Creative Commons licences, and the words of the variants.
CC_VARIANTS = {
    "BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial",
    "BY-ND": "Attribution-NoDerivatives", "BY-NC-SA": "Attribution-NonCommercial-ShareAlike",
    "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}
CC_VERSIONS = {"1.0": "Generic", "2.0": "Generic", "2.5": "Generic", "3.0": "Unported",
               "4.0": "International"}
TEMPLATES |= {f"CC-{variant}-{version}": (
    f"Licensed under CC {variant} {version}.", f"SPDX-License-Identifier: CC-{variant}-{version}",
    f"Licensed under a Creative Commons {words} {version} {where} License.")
    for variant, words in CC_VARIANTS.items() for version, where in CC_VERSIONS.items()}

# What tells licences with nearly the same words apart.
CC_TERMS = re.compile(r"\bby((?:[-_ ](?:nc|nd|sa))+)\b")
SIGNS = {"noncommercial": "nc", "non-commercial": "nc", "noderiv": "nd", "no-deriv": "nd",
         "sharealike": "sa", "share-alike": "sa", "lesser general public": "lesser",
         "lgpl": "lesser", "affero": "affero", "agpl": "affero"}
VERSION = re.compile(
    r"\b(?:version|v|licen[cs]e|[al]?gpl|mpl|apache|cc0|by|nc|nd|sa|attribution|commercial"
    r"|noncommercial|noderivatives|noderivs|derivatives|sharealike|alike|bsd)"
    r"[ ,:_-]*(?:v\.? ?)?(\d{1,2})(?:\.(\d))?(?![\d.]*\d)")
CLAUSES = re.compile(r"\b([234])[- ]clause|\b(two|three|four)[- ]clause")
#: The third condition of the longer one of two licences that begin alike.
THIRD_CLAUSE = re.compile(r"neither the names? of")


def signs(text):
    """(variant words, versions) that a text names."""
    low = " ".join(text.lower().split())
    found = {sign for word, sign in SIGNS.items() if word in low}
    for match in CC_TERMS.finditer(low):
        found.update(re.findall("nc|nd|sa", match[1]))
    for digit, word in CLAUSES.findall(low):
        found.add("clauses " + (digit or {"two": "2", "three": "3", "four": "4"}[word]))
    return found, {(int(a), int(b or 0)) for a, b in VERSION.findall(low)}


def agree(text, whole, template, name):
    """Does a text of the document `whole` name the variant and a version of the template?"""
    (variants, versions), (wanted, wanted_versions) = signs(text), signs(template)
    if name.startswith("BSD-") and "clauses" not in " ".join(variants | wanted):
        return bool(THIRD_CLAUSE.search(" ".join(whole.lower().split()))) == (name == "BSD-3-Clause")
    return variants == wanted and (not wanted_versions or bool(versions & wanted_versions))


#: Beginnings of words that make a sentence worth comparing.
MENTIONS = re.compile(r"licen[cs]e|spdx|permission is hereby|redistribut|public domain|copyright",
                      re.IGNORECASE)
LICENCE_FILE = r"(?i)^(un)?licen[cs]e|^copying|^notice"
SENTENCE = re.compile(r"(?<=[.!?;])\s+")
TERM = re.compile(r"[a-z0-9]+")
#: What may stand before and after the text of a line in a comment.
COMMENT = re.compile(r"^\s*(?:[#*;%>]+|//+|/\*+|--+|<!--|\.\.\s)?\s*|\s*(?:\*+/|-->)?\s*$")
#: Templates from so many terms on are also compared with windows of their length.
WINDOW_TERMS = 12

COUNTED = "term string, n bigint"
CANDIDATES = "doc_id bigint, path string, license string, dot double, mass double, rest string"
#: Terms that a task counts before it passes them on.
COUNTER_TERMS = 200_000


def terms(text):
    return TERM.findall(text.lower())


def notices(text):
    """Sentences, lines and runs of lines of a whole text that mention licensing."""
    if not MENTIONS.search(text):
        return []
    found, run = [], []
    for line in text.split("\n"):
        if MENTIONS.search(line):
            run.append(line)
            found.append(line)
            found += [s for s in SENTENCE.split(line) if s != line and MENTIONS.search(s)]
        else:
            if len(run) > 1:
                found.append("\n".join(run))
            run = []
    if len(run) > 1:
        found.append("\n".join(run))
    block = []
    for line in [*(COMMENT.sub("", x) for x in text.split("\n")), ""]:
        if line:
            block.append(line)
            continue
        joined = " ".join(block)
        if len(block) > 1 and MENTIONS.search(joined):
            found.append(joined)
            found += [s for s in SENTENCE.split(joined) if MENTIONS.search(s)]
        block = []
    return list(dict.fromkeys(found))


class Windows:
    """Runs of a text's terms as long as a long template that stand around its first mention
    as in the template and hold half of its distinct terms."""

    def __init__(self, templates):
        self.around = {}
        for texts in templates.values():
            for text in texts:
                words, mention = terms(text), MENTIONS.search(text)
                if mention and len(words) >= WINDOW_TERMS:
                    at = min(len(terms(text[:mention.start()])), len(words) - 1)
                    self.around.setdefault(words[at], []).append((at, len(words), set(words)))

    def of(self, text):
        if not MENTIONS.search(text):
            return []
        words, found = terms(text), {}
        for i, word in enumerate(words):
            for before, length, own in self.around.get(word, ()):
                window = words[max(0, i - before):max(0, i - before) + length]
                if 2 * len(own.intersection(window)) >= len(own):
                    found[" ".join(window)] = None
        return list(found)


class Templates:
    """Weighted term vectors of the templates and the cosine of any text to the nearest."""

    def __init__(self, templates, df, n):
        self.n, self.df = n, df
        self.vectors, self.texts = [], []
        for name in sorted(templates):
            for text in templates[name]:
                vector = self.weighted(Counter(terms(text)))
                self.vectors.append((name, vector, norm(vector)))
                self.texts.append(text)
        self.holders = {}
        for i, (_, vector, _) in enumerate(self.vectors):
            for term in vector:
                self.holders.setdefault(term, []).append(i)

    def weighted(self, counts):
        return {t: c * (math.log((self.n + 1) / (self.df.get(t, 0) + 1)) + 1)
                for t, c in counts.items()}

    def best(self, vector, text, whole):
        """(dot product by the template's length, licence) of the nearest template whose variant and
        version the text names; of equal ones the first by name."""
        dots = Counter()
        for term, weight in vector.items():
            for i in self.holders.get(term, ()):
                dots[i] += weight * self.vectors[i][1][term]
        near = sorted((-dots[i] / self.vectors[i][2], i) for i in dots)
        # Equal ones differ by rounding only.
        for dot, i in sorted(near, key=lambda x: (round(x[0], 9), x[1])):
            if agree(text, whole, self.texts[i], self.vectors[i][0]):
                return -dot, self.vectors[i][0]
        return 0.0, None

    def nearest(self, text):
        """(cosine, licence) of a text on its own; of equal ones the first licence by name."""
        vector = self.weighted(Counter(terms(text)))
        dot, name = self.best(vector, text, text)
        return (dot / norm(vector), name) if name else (0.0, None)

    def candidate(self, text, threshold, whole=None):
        """(licence, dot, squared weights of template terms, other terms) if `text` reaches the
        threshold when its other terms weigh least; else nothing."""
        counts = Counter(terms(text))
        vector = self.weighted({t: c for t, c in counts.items() if t in self.holders})
        mass = sum(w * w for w in vector.values())
        rest = {t: c for t, c in counts.items() if t not in self.holders}
        dot, name = self.best(vector, text, whole if whole is not None else text)
        if not name or dot < (threshold - 1e-9) * math.sqrt(mass + sum(c * c for c in rest.values())):
            return None
        return name, dot, mass, " ".join(t for t in sorted(rest) for _ in range(rest[t]))


def norm(vector):
    return math.sqrt(sum(w * w for w in vector.values()))


def document_frequencies(files):
    """`term`, `n`: how many files hold each term; a null `term` with the number of files."""
    bounded_batches(files.sparkSession)

    def flushed(df, number):
        return pa.RecordBatch.from_arrays(
            [pa.array([None, *df], pa.string()), pa.array([number, *df.values()], pa.int64())],
            ["term", "n"])

    def rows(batches):
        df, number = Counter(), 0
        for batch in batches:
            for some in slices(batch):
                for text in some.column("text").to_pylist():
                    df.update(set(terms(text)))
                    number += 1
                if len(df) > COUNTER_TERMS:
                    yield flushed(df, number)
                    df, number = Counter(), 0
        yield flushed(df, number)

    return files.select("text").mapInArrow(rows, COUNTED).groupBy("term").agg(F.sum("n").alias("n"))


def candidates(files, known, windows, threshold):
    """Notices and whole licence files that may reach the threshold."""
    by_name = re.compile(LICENCE_FILE)

    def rows(batches):
        for batch in batches:
            for some in slices(batch):
                out = []
                for doc_id, path, text in zip(*[some.column(i).to_pylist() for i in range(3)]):
                    whole = [text] if by_name.search(path.rsplit("/", 1)[-1]) else []
                    found = (known.candidate(p, threshold, text)
                             for p in dict.fromkeys(whole + notices(text) + windows.of(text)))
                    out += [(doc_id, path, *x) for x in dict.fromkeys(found) if x]
                kinds = (pa.int64(), pa.string(), pa.string(), pa.float64(), pa.float64(),
                         pa.string())
                columns = list(zip(*out)) or [()] * len(kinds)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds)],
                    ["doc_id", "path", "license", "dot", "mass", "rest"])

    name = F.element_at(F.split("path", "/"), -1)
    some = files.where(F.col("text").rlike("(?iu)" + MENTIONS.pattern) | name.rlike(LICENCE_FILE))
    return some.select("doc_id", "path", "text").mapInArrow(rows, CANDIDATES)


def own_licenses(files, templates=None, threshold=THRESHOLD):
    """`doc_id`, `path`, `license`, `score` of the files that have a licence of their own."""
    templates = templates or TEMPLATES
    frequencies = stored(document_frequencies(files), "license-terms")
    vocabulary = sorted({t for texts in templates.values() for text in texts for t in terms(text)})
    counted = frequencies.where(F.col("term").isin(vocabulary) | F.col("term").isNull()).collect()
    df = {r["term"]: r["n"] for r in counted}  # one row per term of the templates
    n = df.pop(None, None) or 0
    found = stored(candidates(files, Templates(templates, df, n), Windows(templates), threshold), "license-candidates")
    # Both sides are written before they are joined: then Spark can split a common term.
    words = stored(found.where("rest != ''").select("rest").distinct()
                   .select("rest", F.explode(F.split("rest", " ")).alias("term"))
                   .groupBy("rest", "term").agg(F.count("*").alias("c")), "license-rest-terms")
    weight = F.col("c") * (F.log((F.lit(n) + 1) / (F.col("n") + 1)) + 1)
    # Squares are summed in order, so that repeated runs give the same score.
    squares = F.array_sort(F.collect_list(weight * weight))
    rests = stored(words.join(frequencies, "term").groupBy("rest").agg(
        F.aggregate(squares, F.lit(0.0), lambda x, y: x + y).alias("rest_mass")), "license-rests")
    columns = ("doc_id", "path", "license", "dot", "mass", "rest_mass")
    weighed = (found.where("rest = ''").withColumn("rest_mass", F.lit(0.0)).select(*columns)
               .union(found.where("rest != ''").join(rests, "rest").select(*columns)))
    score = F.col("dot") / F.sqrt(F.col("mass") + F.col("rest_mass"))
    best = F.max(F.struct("score", F.col("license").alias("license"))).alias("best")
    return (weighed.withColumn("score", score).where(F.col("score") >= threshold - 1e-9)
            .groupBy("doc_id", "path").agg(best)
            .select("doc_id", "path", "best.license", "best.score"))


def directory(path):
    return F.regexp_replace(F.regexp_extract(path, r"^(.*)/[^/]*$", 1), r"/+$", "")


def inherited(files, own):
    """`dir` and the licence (`license`, `score`, `from_dir`) that files in it inherit."""
    name = F.element_at(F.split("path", "/"), -1)
    given = (own.where(name.rlike(LICENCE_FILE)).groupBy(directory(F.col("path")).alias("from_dir"))
             .agg(F.max(F.struct("score", "license")).alias("best")))
    given = stored(given.select("from_dir", "best.license", "best.score"), "license-dirs")
    dirs = files.select(directory(F.col("path")).alias("dir")).distinct()
    names = F.split("dir", "/")
    above = F.when(F.col("dir") == "", F.array(F.lit(""))).otherwise(F.transform(
        F.sequence(F.lit(0), F.size(names)),
        lambda i: F.array_join(F.slice(names, 1, i), "/")))
    chains = dirs.select("dir", F.explode(above).alias("from_dir"))
    return (chains.join(given, "from_dir").groupBy("dir")
            .agg(F.max_by(F.struct("license", "score", "from_dir"), F.length("from_dir")).alias("x"))
            .select("dir", "x.*"))


def scan(files, templates=None, threshold=THRESHOLD):
    """`doc_id`, `path`, `license`, `score` and `origin` (`own`, `inherited` or null) of every file.

    `files`: `doc_id`, `path` (directories divided by slashes), `text`. A null text or path
    is an empty one; a null id stays null; repeated rows of one id and path have one row; other
    columns are ignored; no files, no rows. Texts are read whole. A licence file has its own
    licence; where several in one directory differ, the best match counts.
    """
    files = files.select("doc_id", F.coalesce("path", F.lit("")).alias("path"),
                         F.coalesce("text", F.lit("")).alias("text"))
    own = stored(own_licenses(files, templates, threshold), "license-own")
    named = files.select("doc_id", "path").distinct()
    given = inherited(named, own).select(
        F.col("dir"), F.col("license").alias("given"), F.col("score").alias("given_score"))
    mine = own.select(F.col("doc_id").alias("own_id"), F.col("path").alias("own_path"),
                      F.col("license").alias("own_license"), F.col("score").alias("own_score"))
    joined = (named.withColumn("dir", directory(F.col("path")))
              .join(mine, F.col("doc_id").eqNullSafe(F.col("own_id"))
                    & (F.col("path") == F.col("own_path")), "left")
              .join(given, "dir", "left"))
    return joined.select(
        "doc_id", "path", F.coalesce("own_license", "given").alias("license"),
        F.coalesce("own_score", "given_score").alias("score"),
        F.when(F.col("own_license").isNotNull(), "own")
        .when(F.col("given").isNotNull(), "inherited").alias("origin"))
