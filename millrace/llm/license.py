"""License scans: MinHash over overlapping windows finds license notices. DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.llm.tables import stored

CONTAINMENT = 0.8
SHINGLE_WORDS = 5
BANDS = 32  # a window has a similarity of 0.22 or more to a notice that is in it to 0.8: (1 - 0.22) ** 32 = 3e-4 at most
MAX_TEMPLATES = 1000

# The wording of common license notices.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0-notice",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0-notice",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    ),
    ("MIT", "Released under the MIT License."),
    (
        "MIT-notice",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so.",
    ),
    (
        "MPL-2.0-notice",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    (
        "AGPL-3.0-notice",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "Affero General Public License as published by the Free Software Foundation, either version 3 of the "
        "License, or (at your option) any later version.",
    ),
    (
        "Apache-2.0-header",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License.",
    ),
    (
        "BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: 1. Redistributions of source code must retain the above "
        "copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary "
        "form must reproduce the above copyright notice, this list of conditions and the following disclaimer in "
        "the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY "
        "THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT "
        "NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
        "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, "
        "INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF "
        "SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED "
        "AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR "
        "OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF "
        "SUCH DAMAGE.",
    ),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: 1. Redistributions of source code must retain the above "
        "copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary "
        "form must reproduce the above copyright notice, this list of conditions and the following disclaimer in "
        "the documentation and/or other materials provided with the distribution. 3. Neither the name of the "
        "copyright holder nor the names of its contributors may be used to endorse or promote products derived "
        "from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE "
        "COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT "
        "LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
        "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, "
        "INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF "
        "SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED "
        "AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR "
        "OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF "
        "SUCH DAMAGE.",
    ),
    (
        "CC-BY-SA-4.0",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    (
        "CC0-1.0",
        "has waived all copyright and related or neighboring rights to this work",
    ),
    (
        "CC0-1.0-notice",
        "To the extent possible under law, the author(s) have dedicated all copyright and related and "
        "neighboring rights to this software to the public domain worldwide. This software is distributed "
        "without any warranty.",
    ),
    (
        "GPL-2.0-notice",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation; either version 2 of the License, "
        "or (at your option) any later version.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all "
        "copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS "
        "SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR "
        "BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER "
        "RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER "
        "TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    (
        "LGPL-2.1-notice",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
        "Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the "
        "License, or (at your option) any later version.",
    ),
    (
        "LGPL-3.0-notice",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "Lesser General Public License as published by the Free Software Foundation, either version 3 of the "
        "License, or (at your option) any later version.",
    ),
    (
        "MIT-text",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to "
        "the following conditions: The above copyright notice and this permission notice shall be included in "
        "all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY "
        "OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, "
        "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT "
        "HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
        "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE "
        "SOFTWARE.",
    ),
    (
        "Unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
        "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled "
        "binary, for any purpose, commercial or non-commercial, and by any means.",
    ),
]


def words(text: Column) -> Column:
    """Words in lower case, of letters, digits and marks only."""
    plain = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}\p{M}\s]+", "")
    return F.filter(F.split(plain, r"\s+", -1), lambda w: w != "")


def with_shingles(rows: DataFrame, text: Column, keep: Sequence[Column]) -> DataFrame:
    """Hashes of every run of five words, in order; of all words if there are fewer."""
    given = rows.select(*keep, words(text).alias("words"))
    names = given.columns[:-1]
    at = lambda i, k: F.get("words", i + k)
    runs = F.transform(
        F.sequence(F.lit(0), F.greatest(F.size("words") - SHINGLE_WORDS, F.lit(0))),
        lambda i: F.xxhash64(*[at(i, k) for k in range(SHINGLE_WORDS)]),
    )
    return given.select(*names, F.when(F.size("words") > 0, runs).otherwise(F.array().cast("array<bigint>")).alias("shingles"))


def minima(shingles: str, bands: int) -> Column:
    """MinHash values of a set of shingles, one per band."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(bands - 1)),
        lambda band: F.array_min(F.transform(F.col(shingles), lambda s: F.xxhash64(band, s))),
    )


def template_table(spark: SparkSession, templates: Sequence[tuple[str, str]], bands: int) -> DataFrame:
    """``license, cls, size, template`` (its distinct shingles) and ``minima``."""
    if len(templates) > MAX_TEMPLATES:
        raise ValueError(f"more than {MAX_TEMPLATES} templates")
    given = F.inline(F.array(*[F.struct(F.lit(n).alias("license"), F.lit(t).alias("text")) for n, t in templates]))
    made = with_shingles(spark.range(1).select(given), F.col("text"), [F.col("license")])
    made = made.select("license", F.array_distinct("shingles").alias("template")).where(F.size("template") > 0)
    made = made.withColumn("size", F.size("template").cast("bigint"))
    made = made.withColumn("cls", F.ceil(F.log2("size")).cast("int"))
    return stored(made.select("license", "cls", "size", "template", minima("template", bands).alias("minima")), "licenses")


def scan_licenses(
    docs: DataFrame,
    doc: str = "doc_id",
    text: str = "text",
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    containment: float = CONTAINMENT,
    bands: int = BANDS,
) -> DataFrame:
    """License notices found in documents: ``doc``, ``license``, ``n_shared``, ``n_shingles``.

    Notices are partitioned by their number of five-word shingles, by powers of two; a document is
    read in windows of twice that size that begin at every multiple of it, so that a notice lies
    whole in one. A window retrieves a notice if one of ``bands`` minima agrees, and a notice counts
    if a window has a share of ``containment`` of its shingles. ``n_shared`` is the largest number
    that a window has. Notices with much wording in common (GNU licenses, two and three BSD clauses)
    are found together; the one meant is that with the largest ``n_shared / n_shingles``.

    A minimum can only agree where the window has the shingle that is the notice's minimum, so
    signatures are computed for documents that have such a shingle; the others cannot be found
    by any band. Notices are few (``MAX_TEMPLATES``), hence broadcast, and a notice that a third of
    all documents have moves no text.

    NULL, empty and wordless texts have none. Rows that repeat an id are one document, whose best
    window counts; NULL ids are one document too. An empty table gives an empty table.
    """
    notices = template_table(docs.sparkSession, templates, bands)
    # the shingle of every minimum: at most MAX_TEMPLATES * bands hashes
    each = notices.select("cls", "template", F.posexplode("minima").alias("band", "least"))
    minimal = F.filter("template", lambda s: F.xxhash64(F.col("band"), s) == F.col("least"))
    known = [r[0] for r in each.select(F.explode(minimal)).distinct().collect()]
    classes = [r[0] for r in notices.select("cls").distinct().collect()]
    keyed = F.broadcast(notices.select("license", "cls", "size", "template", F.posexplode("minima").alias("band", "least")))

    read = with_shingles(docs, F.col(text), [F.col(doc).alias("doc")])
    # filtered as a list of one: Spark would push a plain filter down and compute the words anew for
    # every shingle; the outer form keeps it from checking the list a second time
    among = F.array(*map(F.lit, known)).cast("array<bigint>")
    marked = F.explode_outer(F.filter(F.array("shingles"), lambda s: F.arrays_overlap(s, among)))
    read = read.select("doc", marked.alias("shingles")).where("shingles is not null")
    halves = F.array(*[F.struct(F.lit(c).alias("cls"), F.lit(1 << c).alias("half")) for c in sorted(classes)])
    sized = read.select("doc", "shingles", F.inline(halves))
    begin = F.explode(F.sequence(F.lit(0), F.size("shingles") - 1, F.col("half"))).alias("begin")
    windows = sized.select("doc", "cls", "half", "shingles", begin)
    windows = windows.select("doc", "cls", F.slice("shingles", F.col("begin") + 1, 2 * F.col("half")).alias("window"))
    banded = windows.select("doc", "cls", "window", F.posexplode(minima("window", bands)).alias("band", "least"))
    met = banded.join(keyed, ["cls", "band", "least"])
    shared = F.size(F.array_intersect("window", "template")).cast("bigint").alias("n_shared")
    found = met.select("doc", "license", F.col("size").alias("n_shingles"), shared)
    found = found.where(F.col("n_shared") >= F.ceil(F.col("n_shingles") * F.lit(containment) - 1e-9))
    best = found.groupBy("doc", "license").agg(F.max("n_shared").alias("n_shared"), F.first("n_shingles").alias("n_shingles"))
    return best.select(F.col("doc").alias(doc), "license", "n_shared", "n_shingles")
