"""Licence scans: a trained paragraph classifier, checked against templates; DataFrame functions and Spark ML only."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.lineage import materialize

MAX_FIT_ROWS = 20_000          # the bound of the paragraphs that are fitted on: licence-like ones, and others
FIT_TASKS = 48
FEATURES = 8_192              # of 20 names: 164,000 coefficients, of which the driver keeps a few copies
UNKNOWN = "unknown"
CONFIRMED = 0.6                # share of a template's word pairs that confirms a prediction
SURE = 0.99                    # share of a family's calibration paragraphs that must reach its cut
_WORD = r"[\p{L}\p{N}](?:[\p{L}\p{N}.\-]*[\p{L}\p{N}])?"      # dots and hyphens at a word's end are none of it
_HINTS = r"(?i)licen[sc]|copyright|rights\s+reserved|permission|redistribut|warrant"   # chooses fit rows, not results

#: Sentences by which texts name their licence; the SQL knows these only.
TEMPLATES = {
    "all-rights-reserved": ["All rights reserved."],
    "apache-2.0": ["Licensed under the Apache License, Version 2.0."],
    "bsd-3-clause": ["Redistribution and use in source and binary forms, with or without modification, are permitted."],
    "cc-by-4.0": ["Licensed under CC BY 4.0.", "Licensed under a Creative Commons Attribution 4.0 International License."],
    "cc-by-nc-4.0": ["Licensed under CC BY-NC 4.0.", "Licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "cc-by-sa-4.0": ["Licensed under CC BY-SA 4.0.", "Licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "gpl-3.0": ["This work is licensed under the GNU General Public License, version 3."],
    "mit": ["Released under the MIT License.", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software."],
}

_GNU = "This program is free software: you can redistribute it and/or modify it under the terms of the {%s} as published by the Free Software Foundation, either {%s} of the License, or (at your option) any later version."
_GNU_ONLY = "it under the terms of the {%s} as published by the Free Software Foundation, {%s}"
_CC = "This work is licensed under a {Creative Commons %s %s} License."
_BSD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"


def _gnu(name: str, spdx: str, *versions: str) -> list[str]:
    out = []
    for v in versions:
        out += [_GNU % (name, f"version {v}"), _GNU_ONLY % (name, f"version {v}")]
        out += [f"licensed under the {{{name}}}, {{version {v}}}.", f"{{{name} v{v}}}", f"the {{{name} {v}}}", f"{{{spdx.split('-')[0]} {v}}} license", f"licensed under the {{{spdx.split('-')[0]}v{v} license}}"]
    return out + _spdx(spdx, f"{spdx}-only", f"{spdx}-or-later")


def _spdx(*ids: str) -> list[str]:
    return [f"{{SPDX-License-Identifier: {i}}}" for i in ids]


def _cc(kind: str, name: str, version: str) -> list[str]:
    return [_CC % (name, version), f"Licensed under {{CC {kind} {version}}}.", f"a {{Creative Commons {name} {version} International License}}.", *_spdx(f"CC-{kind}-{version}")]


#: The sentences above, SPDX ids and the usual headers and grants of more families. All word pairs in braces (name and version) must be in a paragraph.
FAMILIES = {
    "agpl-3.0": _gnu("GNU Affero General Public License", "AGPL-3.0", "3", "3.0"),
    "all-rights-reserved": ["{All rights reserved}."],
    "apache-2.0": [
        "Licensed under the {Apache License, Version 2.0}.", "Licensed under the {Apache License, Version 2.0} (the License); you may not use this file except in compliance with the License.",
        "licensed under the {Apache License 2.0}", "licensed under the {Apache 2.0 license}", "{Apache-2.0 License}", *_spdx("Apache-2.0")],
    "bsd-2-clause": ["{BSD 2-Clause} License", "Simplified {BSD License}", "{Simplified BSD} License", "{2-clause BSD} license", *_spdx("BSD-2-Clause")],
    "bsd-3-clause": [
        "{Redistribution and use in source and binary forms}, with or without modification, are permitted.", _BSD.replace("Redistribution and use in source and binary forms", "{Redistribution and use in source and binary forms}"),
        "{BSD 3-Clause} License", "{3-clause BSD} license", "{New BSD} License", "{Revised BSD} License", *_spdx("BSD-3-Clause"),
        "Neither the {name of the copyright holder nor the names of its contributors} may be used to endorse or promote products derived from this software"],
    "bsl-1.0": ["Distributed under the {Boost Software License, Version 1.0}.", *_spdx("BSL-1.0")],
    "cc-by-3.0": _cc("BY", "Attribution", "3.0"),
    "cc-by-4.0": _cc("BY", "Attribution", "4.0"),
    "cc-by-nc-4.0": _cc("BY-NC", "Attribution-NonCommercial", "4.0"),
    "cc-by-nc-sa-4.0": _cc("BY-NC-SA", "Attribution-NonCommercial-ShareAlike", "4.0"),
    "cc-by-nd-4.0": _cc("BY-ND", "Attribution-NoDerivatives", "4.0"),
    "cc-by-sa-3.0": _cc("BY-SA", "Attribution-ShareAlike", "3.0"),
    "cc-by-sa-4.0": _cc("BY-SA", "Attribution-ShareAlike", "4.0"),
    "cc0-1.0": ["{CC0 1.0} Universal", "{Creative Commons Zero} v1.0 Universal", "released under {CC0 1.0}", *_spdx("CC0-1.0")],
    "epl-1.0": ["made available under the terms of the {Eclipse Public License v1.0}", "the {Eclipse Public License, Version 1.0}", *_spdx("EPL-1.0")],
    "epl-2.0": ["made available under the terms of the {Eclipse Public License 2.0}", "the {Eclipse Public License v2.0}", "the {Eclipse Public License, Version 2.0}", *_spdx("EPL-2.0")],
    "gpl-2.0": _gnu("GNU General Public License", "GPL-2.0", "2", "2.0"),
    "gpl-3.0": ["This work is licensed under the {GNU General Public License, version 3}.", *_gnu("GNU General Public License", "GPL-3.0", "3", "3.0")],
    "isc": [
        "{ISC License}", "licensed under the {ISC License}", *_spdx("ISC"),
        "{Permission to use, copy, modify, and/or distribute this software} for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."],
    "lgpl-2.1": _gnu("GNU Lesser General Public License", "LGPL-2.1", "2.1"),
    "lgpl-3.0": _gnu("GNU Lesser General Public License", "LGPL-3.0", "3", "3.0"),
    "mit": [
        "Released under the {MIT License}.", "{Permission is hereby granted, free of charge, to any person obtaining a copy of this software}.", "{MIT License}", *_spdx("MIT"),
        "{Permission is hereby granted, free of charge, to any person obtaining a copy of this software} and associated documentation files (the Software), to deal in the Software without restriction"],
    "mpl-2.0": [
        "This Source Code Form is subject to the terms of the {Mozilla Public License, v. 2.0}.", "the {Mozilla Public License, version 2.0}", "the {Mozilla Public License 2.0}", *_spdx("MPL-2.0")],
    "unlicense": ["This is free and unencumbered software {released into the public domain}.", *_spdx("Unlicense")],
    "zlib": ["This software is provided {as-is, without any express or implied warranty}. In no event will the authors be held liable", "the {zlib License}", *_spdx("Zlib")],
}


def class_of(family: str) -> str:
    """The licence's name without its version: what the classifier tells apart. Templates tell versions apart."""
    return re.split(r"-\d", family)[0]


def _template(family: str, marked: str) -> tuple[str, str, list[str], list[str]]:
    """family, text, its distinct word pairs, those of them that must be there."""
    def pairs(text: str) -> list[str]:
        found = [w.rstrip(".-") for w in re.findall(r"[a-z0-9][a-z0-9.\-]*", text.lower())]
        return list(dict.fromkeys(f"{a} {b}" for a, b in zip(found, found[1:])))

    text = marked.replace("{", "").replace("}", "")
    return family, text, pairs(text), list(dict.fromkeys(p for part in re.findall(r"\{(.*?)\}", marked) for p in pairs(part)))


@dataclass(frozen=True)
class LicenseModel:
    classes: list[str]               # by class number; the last is UNKNOWN
    classifier: LogisticRegressionModel
    cuts: list[float]                # calibrated: a lower probability is unknown
    templates: list[tuple[str, str, list[str], list[str]]]


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(_WORD), F.lit(0))


def _grams(words: Column) -> Column:
    """Words and pairs of neighbouring words."""
    return F.concat(words, _pairs(words))


def _pairs(words: Column) -> Column:
    following = F.slice(words, 2, F.greatest(F.size(words), F.lit(1)))
    pairs = F.zip_with(words, following, lambda a, b: F.concat(a, F.lit(" "), b))
    return F.filter(pairs, lambda p: p.isNotNull())


def _with_likeness(df: DataFrame, templates: list[tuple[str, str, list[str], list[str]]], name: Column | None = None) -> DataFrame:
    """
    `df` (with `_words`) plus _likeness and _family: of the template whose word pairs the paragraph has most of, among those whose required pairs it
    has all of (likeness 0: none); of one class only if it is given. Templates are held only against those pairs of the paragraph that any template has. They
    are columns of a generator, so that filters on them don't make Spark work them out again.
    """
    # one expression in SQL's words: thousands of single columns take the driver minutes
    quoted = lambda items: "CAST(array(" + ", ".join(f"'{x}'" for x in items) + ") AS array<string>)"
    known = F.expr("array(" + ", ".join(
        f"named_struct('name', '{class_of(family)}', 'family', '{family}', 'own', {quoted(own)}, 'needed', {quoted(needed)})"
        for family, _, own, needed in templates) + ")")
    every = F.expr(quoted(dict.fromkeys(x for _, _, own, needed in templates for x in (*own, *needed))))

    def score(t: Column) -> Column:
        confirmed = F.size(F.array_except(t["needed"], F.col("_shared"))) == 0
        if name is not None:
            confirmed &= t["name"] == name
        return F.struct(
            F.when(confirmed, F.size(F.array_intersect(t["own"], F.col("_shared"))) / F.size(t["own"])).otherwise(0.0).alias("_likeness"),
            F.when(confirmed, F.size(t["needed"])).otherwise(0).alias("_needed"), t["family"].alias("_family"))

    shared = df.withColumn("_shared", F.array_intersect(_pairs(F.col("_words")), every))
    return shared.select(*shared.columns, F.inline(F.array(F.array_max(F.transform(known, score))))).drop("_shared", "_needed")


def paragraphs_of(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, text_key, paragraph, text): the non-empty lines of every whole text."""
    return docs.select(
        F.col(id_column).alias("doc_id"), F.xxhash64(text_column).alias("text_key"),
        F.posexplode(F.split(F.col(text_column), r"[\r\n]+", -1)).alias("paragraph", "text")).filter("trim(text) != ''")


def fit_licenses(
    docs: DataFrame, templates: dict[str, list[str]] = FAMILIES, text_column: str = "text", max_rows: int = MAX_FIT_ROWS,
) -> LicenseModel:
    """
    Learn the licences' names from paragraphs of the corpus. A paragraph's label is the name in the template that it has nearly
    all word pairs of; paragraphs with few of any template's are unknown. At most `max_rows` distinct paragraphs that use
    licence words and as many others are taken, chosen by a hash, with 1 + ln of their number as weights, so that a frequent line can't fill the
    sample; the templates themselves always belong to them, so that every name can be learned. Sparse binary word and word-pair features, multinomial logistic regression with an
    elastic net. A quarter of the rows is left out of the fit and calibrates each name's cut: the probability that SURE of its paragraphs reach.
    """
    spark = docs.sparkSession
    known = [_template(family, text) for family, texts in sorted(templates.items()) for text in texts]
    classes = [*sorted({class_of(family) for family in templates}), UNKNOWN]
    lines = docs.select(F.explode(F.split(F.col(text_column), r"[\r\n]+", -1)).alias("text")).filter("trim(text) != ''")
    order = F.xxhash64("text")
    hint = F.col("text").rlike(_HINTS)
    # distinct paragraphs by their hashes alone: the highest hash that is still taken, of each kind
    hashes = materialize(lines.select(hint.alias("hint"), order.alias("hash")).distinct(), "license-hashes")
    last = [hashes.filter(F.col("hint") == kind).orderBy("hash").limit(max_rows).agg(F.max("hash")).first()[0] for kind in (True, False)]
    taken = F.when(hint, order <= F.lit(last[0])).otherwise(order <= F.lit(last[1]))
    found = lines.filter(taken).groupBy("text").agg((F.log(F.count("*").cast("double")) + 1).alias("weight")).withColumn("_own", F.lit(False))
    own = spark.createDataFrame([(text,) for _, text, _, _ in known], "text string").withColumns({"weight": F.lit(1.0), "_own": F.lit(True)})
    rows = found.unionByName(own).repartition(FIT_TASKS)
    rows = _with_likeness(rows.withColumn("_words", _words(F.col("text"))), known)
    number = F.element_at(F.create_map(*[F.lit(x) for f in sorted(templates) for x in (f, float(classes.index(class_of(f))))]), F.col("_family"))
    label = F.when(F.col("_likeness") >= 0.9, number).when(F.col("_likeness") < 0.5, F.lit(float(len(classes) - 1)))
    rows = rows.withColumn("label", label).filter("label IS NOT NULL").select(
        "label", "weight", "_own", _grams(F.col("_words")).alias("grams"), (F.pmod(F.xxhash64("text", F.lit(7)), F.lit(4)) == 0).alias("_calibrate"))
    rows = materialize(rows, "license-rows")
    features = HashingTF(inputCol="grams", outputCol="features", numFeatures=FEATURES, binary=True)
    fit = features.transform(rows.filter("_own OR NOT _calibrate"))
    classifier = LogisticRegression(family="multinomial", regParam=1e-4, elasticNetParam=0.5, maxIter=25, weightCol="weight").fit(fit.select("features", "label", "weight"))
    scored = classifier.transform(features.transform(rows.filter("_own OR _calibrate")))
    own_probability = F.element_at(vector_to_array("probability"), (F.col("label") + 1).cast("int"))
    cuts = {r["label"]: r["cut"] for r in scored.groupBy("label").agg(F.percentile_approx(own_probability, 1 - SURE, 10_000).alias("cut")).collect()}
    return LicenseModel(classes, classifier, [min(0.95, cuts.get(float(i), 0.5) * 0.9) for i in range(len(classes))], known)


def scan_licenses(docs: DataFrame, model: LicenseModel, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """
    doc_id, text_key, paragraph, family, probability, likeness of every paragraph that names a licence: the classifier's name
    reaches its calibrated cut, and a template of that name confirms it and gives the family with its version. Every paragraph of every whole text is scored.
    Null and empty texts have no paragraphs; null ids and repeated rows are scanned like others; other columns are not
    read; an empty table gives an empty table. Nothing is shuffled.
    """
    lines = paragraphs_of(docs, id_column, text_column).withColumn("_words", _words(F.col("text"))).withColumn("_grams", _grams(F.col("_words")))
    features = HashingTF(inputCol="_grams", outputCol="features", numFeatures=FEATURES, binary=True)
    scored = model.classifier.transform(features.transform(lines))
    at = (F.col("prediction") + 1).cast("int")
    named = scored.select("doc_id", "text_key", "paragraph", "_words", F.inline(F.array(F.struct(
        F.element_at(vector_to_array("probability"), at).alias("_p"), F.element_at(F.array(*map(F.lit, model.cuts)), at).alias("_cut"),
        F.element_at(F.array(*map(F.lit, model.classes)), at).alias("_name")))))
    known = named.filter((F.col("_name") != UNKNOWN) & (F.col("_p") >= F.col("_cut")))
    return _with_likeness(known, model.templates, F.col("_name")).filter(F.col("_likeness") >= CONFIRMED).select(
        "doc_id", "text_key", "paragraph", F.col("_family").alias("family"), F.col("_p").alias("probability"), F.col("_likeness").alias("likeness"))


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The licence families that every document names, joined by commas ('': none), and in how many paragraphs."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = scan_licenses(docs, fit_licenses(docs))
    each = found.groupBy("doc_id", "text_key", "paragraph", "family").agg(F.lit(1).alias("_one"))        # repeated rows once
    per_doc = each.groupBy("doc_id", "text_key").agg(
        F.array_join(F.sort_array(F.collect_set("family")), ",").alias("licenses"), F.count("*").alias("n_paragraphs"))
    keys = docs.select("doc_id", F.xxhash64("text").alias("text_key")).alias("d")
    same = F.col("d.doc_id").eqNullSafe(F.col("p.doc_id")) & F.col("d.text_key").eqNullSafe(F.col("p.text_key"))
    return keys.join(per_doc.alias("p"), same, "left").select(
        "d.doc_id", F.coalesce("licenses", F.lit("")).alias("licenses"), F.coalesce("n_paragraphs", F.lit(0).cast("long")).alias("n_paragraphs"))
