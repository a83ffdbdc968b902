"""Licence scan by sentence rules (DataFrame functions only).

Texts are split into sentences (and, beside them, into lines), each sentence is
normalised and mapped to the identifier of a known licence sentence; the
document's identifier sequence is then matched against ordered rules, longer
ones first; a matched stretch is consumed. All of it is one projection next to
the scan: no shuffle, no join, whatever a line's frequency.

Defined cases: null and empty text have no sentences and no licences; unknown
sentences between known ones do not break a rule; the same licence found again
is listed once; texts of any length are read whole; repeated rows give repeated rows; an empty table gives none;
other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Known licence sentences, normalised (lower case, "licence" spelt
# "license", letters and digits only, single spaces).
SENTENCES = {
    "short_mit": "released under the mit license",
    "short_mit_2": "licensed under the mit license",
    "short_mit_3": "this project is licensed under the mit license",
    "spdx_mit": "spdx license identifier mit",
    "mit_grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit_notice": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "mit_warranty": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "short_apache2": "licensed under the apache license version 2 0",
    "short_apache2_2": "released under the apache license version 2 0",
    "spdx_apache2": "spdx license identifier apache 2 0",
    "apache2_grant": "licensed under the apache license version 2 0 the license",
    "apache2_use": "you may not use this file except in compliance with the license",
    "apache2_copy": "you may obtain a copy of the license at",
    "apache2_warranty": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "short_gpl3": "this work is licensed under the gnu general public license version 3",
    "short_gpl3_2": "licensed under the gnu general public license version 3",
    "short_gpl2": "this work is licensed under the gnu general public license version 2",
    "spdx_gpl3": "spdx license identifier gpl 3 0",
    "gpl_grant_3": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl_grant_2": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "gpl_warranty": "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "short_cc_by": "licensed under cc by 4 0",
    "short_cc_by_sa": "licensed under cc by sa 4 0",
    "short_cc_by_nc": "licensed under cc by nc 4 0",
    "long_cc_by": "this work is licensed under a creative commons attribution 4 0 international license",
    "long_cc_by_sa": "this work is licensed under a creative commons attribution sharealike 4 0 international license",
    "long_cc_by_nc": "this work is licensed under a creative commons attribution noncommercial 4 0 international license",
    "bsd_redistribution": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd_source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd_binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "bsd_endorse": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "short_bsd3": "licensed under the bsd 3 clause license",
}
# Ordered rules, (licence, identifiers in order).
RULES = [
    ("MIT", ["mit_grant", "mit_notice", "mit_warranty"]),
    ("BSD-3-Clause", ["bsd_redistribution", "bsd_source", "bsd_binary", "bsd_endorse"]),
    ("BSD-2-Clause", ["bsd_redistribution", "bsd_source", "bsd_binary"]),
    ("Apache-2.0", ["apache2_grant", "apache2_use", "apache2_copy", "apache2_warranty"]),
    ("Apache-2.0", ["apache2_grant", "apache2_use"]),
    ("GPL-3.0-or-later", ["gpl_grant_3", "gpl_warranty"]),
    ("GPL-2.0-or-later", ["gpl_grant_2", "gpl_warranty"]),
    ("GPL-3.0-or-later", ["gpl_grant_3"]),
    ("GPL-2.0-or-later", ["gpl_grant_2"]),
    ("MIT", ["mit_grant"]),
    ("MIT", ["short_mit"]), ("MIT", ["short_mit_2"]), ("MIT", ["short_mit_3"]), ("MIT", ["spdx_mit"]),
    ("Apache-2.0", ["short_apache2"]), ("Apache-2.0", ["short_apache2_2"]), ("Apache-2.0", ["spdx_apache2"]),
    ("GPL-3.0", ["short_gpl3"]), ("GPL-3.0", ["short_gpl3_2"]), ("GPL-3.0", ["spdx_gpl3"]), ("GPL-2.0", ["short_gpl2"]),
    ("CC-BY-4.0", ["short_cc_by"]), ("CC-BY-4.0", ["long_cc_by"]),
    ("CC-BY-SA-4.0", ["short_cc_by_sa"]), ("CC-BY-SA-4.0", ["long_cc_by_sa"]),
    ("CC-BY-NC-4.0", ["short_cc_by_nc"]), ("CC-BY-NC-4.0", ["long_cc_by_nc"]),
    ("BSD-3-Clause", ["short_bsd3"]),
]
# Every known sentence holds one of these, so other sentences need no normalising.
HINT = r"(?i)licen[cs]e|licensed under cc|permission|copyright|warrant|redistribut"
SENTENCE_END = r"([.;:!?])[ \t\r\n]+|\n[ \t\r]*\n"


def _identified(parts: Column) -> Column:
    """[(identifier)] of the known sentences among ``parts``, in order."""
    known = F.create_map(*[F.lit(x) for k, v in SENTENCES.items() for x in (v, k)])
    normal = F.transform(F.filter(parts, lambda s: s.rlike(HINT)), lambda s: F.trim(F.regexp_replace(
        F.regexp_replace(F.lower(s), "licence", "license"), r"[^\p{L}\p{N}]+", " ")))
    return F.filter(F.transform(normal, lambda s: F.try_element_at(known, s)), lambda k: k.isNotNull())


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, sentence_ids (in order), licenses (by rule order), licensed."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    d = docs.select(F.col(id_col).alias("doc_id"),
                    _identified(F.split(F.regexp_replace(text, SENTENCE_END, "$1\u0001"), "\u0001")).alias("seq"),
                    _identified(F.split(text, "\n")).alias("by_line"))
    d = d.select("doc_id", F.concat("seq", F.array_except("by_line", "seq")).alias("sentence_ids"))
    d = d.withColumn("rest", F.concat(F.lit(" "), F.array_join("sentence_ids", "  "), F.lit(" ")))
    d = d.withColumn("found", F.expr("cast(array() as array<string>)"))
    # fold: a rule that matches adds its licence and consumes its sentences
    state = F.struct(F.col("rest"), F.col("found"))
    rules = F.array(*[F.struct(F.lit(lic).alias("lic"), F.lit(" " + "  ".join(ids) + " ").alias("ids")) for lic, ids in RULES])
    folded = F.aggregate(rules, state, lambda s, r: F.struct(
        F.replace(s["rest"], r["ids"], F.lit("")).alias("rest"),
        F.when(F.contains(s["rest"], r["ids"]), F.array_union(s["found"], F.array(r["lic"]))).otherwise(s["found"]).alias("found")))
    licenses = F.when(F.size("sentence_ids") > 0, folded["found"]).otherwise(F.col("found"))
    return d.select("doc_id", "sentence_ids", licenses.alias("licenses")).withColumn("licensed", F.size("licenses") > 0)


def op5_licenses(spark, sf_dir: str) -> DataFrame:
    from ..sources.tables import read_table
    out = scan_licenses(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.array_join("sentence_ids", ",").alias("sentence_ids"),
                      F.array_join("licenses", ",").alias("licenses"), "licensed")
