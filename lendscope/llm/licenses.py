"""Licence scan by sparse TF-IDF cosine and directory inheritance. DataFrame expressions only.

Every line of every text that speaks of a licence is a notice; a file named like a licence file
is one notice as a whole. Equal notices are one row with a count. Notices and templates become
sparse vectors of words weighted by TF-IDF (document frequencies over all notices of all
documents), and a notice takes the licence of the template with the largest cosine, if it is
large enough. A document without a licence of its own inherits the one of the licence file in
its nearest ancestor directory, found by joining directories, not documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lendscope.llm.common import saved

#: Cosine from which a notice has a template's licence, and share of a text's characters in
#: such notices from which the text counts as a licence file of its directory.
COSINE, FILE_SHARE = 0.55, 0.5

#: What a notice holds, in lower case.
SIGNS = ("licen", "copyright", "all rights reserved", "public domain", "spdx", "copyleft")
LICENSE_NAMES = r"(?i)(^|/)(licen[cs]e|copying|unlicense|notice)([.\-_][^/]*)?$"

#: Licence and the wording of a notice of it.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software under the MIT License"),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("GPL-2.0", "This program is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("MPL-2.0", "This file is subject to the terms of the Mozilla Public License, version 2.0."),
    ("ISC", "Released under the ISC License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has dedicated this work to the public domain under CC0 1.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain. The Unlicense"),
    ("Proprietary", "Copyright. All rights reserved."),
]


def _terms(text: Column) -> Column:
    """Words of letters, digits and inner points, plus signs and hyphens, in lower case."""
    parts = F.split(F.lower(text), r"[^\p{L}\p{N}.+-]+")
    trimmed = F.transform(parts, lambda w: F.regexp_replace(w, r"^[.+-]+|[.+-]+$", ""))
    return F.filter(trimmed, lambda w: w != "")


def _speaks(text: Column) -> Column:
    lowered = F.lower(text)
    said = F.lit(False)
    for sign in SIGNS:
        said = said | F.contains(lowered, F.lit(sign))
    return said


def _vectors(passages: DataFrame, key: str) -> DataFrame:
    """key, word, tf of each passage."""
    return (
        passages.select(key, F.explode(_terms(F.col("notice"))).alias("word"))
        .groupBy(key, "word")
        .agg(F.count(F.lit(1)).alias("tf"))
    )


def _templates(spark: SparkSession) -> DataFrame:
    rows = [(k, license, text) for k, (license, text) in enumerate(TEMPLATES)]
    return spark.createDataFrame(rows, "template int, license string, notice string")


def match_notices(notices: DataFrame) -> DataFrame:
    """notice, license, cosine of the best template for each notice that reaches COSINE.

    `notices` has distinct notices and how many documents hold them (n_docs). Ties go to the
    template listed first.
    """
    spark = notices.sparkSession
    templates = _templates(spark)
    named = notices.select("notice", "n_docs", F.xxhash64("notice").alias("id"))
    vectors = saved(_vectors(named.select("id", "notice"), "id"), "licences")
    wordings = _vectors(templates, "template")
    total = (named.agg(F.sum("n_docs")).first()[0] or 0) + len(TEMPLATES)
    # One row for each word, counted with multiplicities before it meets the notices again.
    seen = (
        vectors.join(named.select("id", "n_docs"), "id")
        .select("word", "n_docs")
        .unionAll(wordings.select("word", F.lit(1).cast("long").alias("n_docs")))
        .groupBy("word")
        .agg(F.sum("n_docs").alias("df"))
    )
    weights = saved(
        seen.select("word", (F.log((1 + F.lit(total)) / (1 + F.col("df"))) + 1).alias("idf")),
        "licences",
    )
    weighted = saved(
        vectors.join(weights, "word").select("id", "word", (F.col("tf") * F.col("idf")).alias("w")),
        "licences",
    )
    norms = weighted.groupBy("id").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    template_w = wordings.join(weights, "word").select(
        "template", "word", (F.col("tf") * F.col("idf")).alias("tw")
    )
    template_norms = template_w.groupBy("template").agg(
        F.sqrt(F.sum(F.col("tw") * F.col("tw"))).alias("tnorm")
    )
    # The templates' words: as many as the list above has.
    unit = template_w.join(template_norms, "template").select(
        "template", "word", (F.col("tw") / F.col("tnorm")).alias("tw")
    )
    products = (
        weighted.join(F.broadcast(unit), "word")
        .groupBy("id", "template")
        .agg(F.sum(F.col("w") * F.col("tw")).alias("product"))
    )
    cosine = F.round(F.col("product") / F.col("norm"), 9)
    best = (
        products.join(norms, "id")
        .withColumn("cosine", cosine)
        .where(F.col("cosine") >= COSINE)
        .groupBy("id")
        .agg(F.min(F.struct(-F.col("cosine"), "template")).alias("best"))
        .select("id", F.col("best.template").alias("template"), (-F.col("best.col1")).alias("cosine"))
    )
    return (
        named.join(best, "id")
        .join(F.broadcast(templates.select("template", "license")), "template")
        .select("notice", "license", "cosine")
    )


def _plain(path: Column) -> Column:
    """A path without empty parts."""
    return F.array_join(F.filter(F.split(path, "/"), lambda p: p != ""), "/")


def _folder(path: Column) -> Column:
    return F.regexp_replace(path, r"/?[^/]*$", "")


def scan(
    docs: DataFrame, id_col: str, text_col: str, path: Column, named_only: bool = False
) -> DataFrame:
    """doc_id, path, license, origin (own, inherited or none), cosine, from_path and n_notices
    of every row.

    A null text has no notices; a null path lies in the root directory. Of several licences in
    a text the one with the largest cosine counts (ties: the first by name); of several
    licence files in a directory likewise (ties: the first path). Rows may repeat; an empty
    table gives an empty result; other columns are ignored. With `named_only`, only files named
    like a licence file pass theirs on, not short texts of which half is notice.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    given = docs.select(
        F.col(id_col).alias("doc_id"), _plain(F.coalesce(path, F.lit(""))).alias("path"), text.alias("text")
    )
    by_name = F.col("path").rlike(LICENSE_NAMES)
    lines = F.filter(F.split("text", "\n"), lambda line: _speaks(line))
    notices = saved(
        given.where(_speaks(F.col("text")) | (by_name & (F.col("text") != "")))
        .select(
            "doc_id",
            "path",
            by_name.alias("by_name"),
            F.greatest(F.length("text"), F.lit(1)).alias("chars"),
            F.explode(
                F.when(by_name, F.array("text")).otherwise(lines)
            ).alias("line"),
        )
        .select("*", F.trim("line").alias("notice"))
        .drop("line"),
        "licences",
    )
    distinct = notices.groupBy("notice").agg(F.count(F.lit(1)).alias("n_docs"))
    matched = saved(match_notices(distinct), "licences")
    held = notices.join(matched, "notice").groupBy("doc_id", "path", "by_name", "chars").agg(
        F.min(F.struct(-F.col("cosine"), "license")).alias("best"),
        F.count(F.lit(1)).alias("n_notices"),
        F.sum(F.length("notice")).alias("said"),
    )
    own = saved(
        held.select(
            "doc_id",
            "path",
            F.col("best.license").alias("license"),
            (-F.col("best.col1")).alias("cosine"),
            "n_notices",
            (
                F.col("by_name") | (~F.lit(named_only) & (F.col("said") >= F.col("chars") * FILE_SHARE))
            ).alias("is_file"),
        ),
        "licences",
    )
    # One licence for each directory that has a licence file.
    files = own.where("is_file").groupBy(_folder(F.col("path")).alias("folder")).agg(
        F.min(F.struct(-F.col("cosine"), "path", "license")).alias("f")
    )
    files = files.select(
        "folder",
        F.col("f.license").alias("file_license"),
        (-F.col("f.col1")).alias("file_cosine"),
        F.col("f.path").alias("file_path"),
    )
    # Directories, each once, with all their ancestors and the root.
    folders = given.select(_folder(F.col("path")).alias("home")).distinct()
    up = folders.select(
        "home", F.explode(_ancestors(F.col("home"))).alias("step")
    ).select("home", F.col("step.folder").alias("folder"), F.col("step.depth").alias("depth"))
    nearest = (
        up.join(files, "folder")
        .groupBy("home")
        .agg(F.max(F.struct("depth", "file_license", "file_cosine", "file_path")).alias("n"))
        .select("home", "n.file_license", "n.file_cosine", "n.file_path")
    )
    nearest = saved(nearest, "licences")
    own = own.dropDuplicates(["doc_id", "path"])
    rows = given.select("doc_id", "path")
    same = rows["doc_id"].eqNullSafe(own["doc_id"]) & (rows["path"] == own["path"])
    joined = rows.join(own, same, "left").select(
        rows["doc_id"], rows["path"], "license", "cosine", "n_notices"
    )
    return (
        joined.withColumn("home", _folder(F.col("path")))
        .join(nearest, "home", "left")
        .select(
            "doc_id",
            "path",
            F.coalesce("license", "file_license").alias("license"),
            F.when(F.col("license").isNotNull(), "own")
            .when(F.col("file_license").isNotNull(), "inherited")
            .otherwise("none")
            .alias("origin"),
            F.coalesce("cosine", "file_cosine").alias("cosine"),
            F.when(F.col("license").isNotNull(), F.col("path"))
            .otherwise(F.col("file_path"))
            .alias("from_path"),
            F.coalesce("n_notices", F.lit(0)).cast("long").alias("n_notices"),
        )
    )


def _ancestors(folder: Column) -> Column:
    """The directory itself and all above it, with their depth; the root has depth 0."""
    parts = F.filter(F.split(folder, "/"), lambda p: p != "")
    return F.transform(
        F.sequence(F.lit(0), F.size(parts)),
        lambda k: F.struct(
            F.array_join(F.slice(parts, F.lit(1), k), "/").alias("folder"), k.alias("depth")
        ),
    )
