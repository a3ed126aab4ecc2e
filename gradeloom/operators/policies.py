"""Rule tables.  All values in this module are fixed values of the task and are stated plainly."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The family of each licence id that permits derivatives and redistribution.
LICENCE_FAMILY = {
    "cc-zero": "public domain dedication",
    "cc-pddc": "public domain",
    "other-pd": "public domain",
    "cc-by": "attribution",
    "cc-by-2.0": "attribution",
    "cc-by-3.0": "attribution",
    "cc-by-3.0-at": "attribution",
    "cc-by-3.0-us": "attribution",
    "cc-by-4.0": "attribution",
    "cc-by-sa": "share-alike",
    "cc-by-sa-2.0": "share-alike",
    "cc-by-sa-3.0": "share-alike",
    "cc-by-sa-4.0": "share-alike",
    "apache2.0": "permissive-oss",
    "bsd-3-clause": "permissive-oss",
    "mit-license": "permissive-oss",
    "etalab-2.0": "open-government",
    "ogl-uk-3.0": "open-government",
    "other-open": "open",
}

# Why a licence id is refused.
LICENCE_REFUSAL = {
    "cc-by-nd-1.0": "no-derivatives",
    "cc-by-nd-2.5": "no-derivatives",
    "cc-by-nd-4.0": "no-derivatives",
    "cc-by-nc-1.0": "non-commercial",
    "cc-by-nc-3.0": "non-commercial",
    "cc-by-nc-4.0": "non-commercial",
    "cc-by-nc-sa-1.0": "non-commercial",
    "cc-by-nc-sa-2.0": "non-commercial",
    "cc-by-nc-sa-4.0": "non-commercial",
    "cc-nc": "non-commercial",
    "cc-by-nc-nd-1.0": "non-commercial + no-derivatives",
    "cc-by-nc-nd-3.0-igo": "non-commercial + no-derivatives",
    "cc-by-nc-nd-4.0": "non-commercial + no-derivatives",
    "notspecified": "no licence stated",
    "other-closed": "closed",
    "nlpl": "unclear id, treated as closed",
    "other-at": "unclear id, treated as closed",
}
UNKNOWN_LICENCE = "licence id not in the reviewed list — refused pending review"

# Triage weights, penalties and thresholds.
TRIAGE_WEIGHTS = {"rich_slides": 40, "usable_ratio": 20, "scarcity": 25, "media": 15}
TRIAGE_PENALTIES = {"mostly_pasted": 40, "too_thin": 40}
TRIAGE_VERSION = 2
MIN_CONTENT, MAX_HARD = 4, 1
SLIDE_BAND = (5, 25)
VERDICT_LINES = (("promising", 50.0), ("marginal", 28.0))
BLANK_STDDEV = 4.0

# Why an input file is refused.
MAGIC_OLE2 = "D0CF11E0"
MAGIC_ZIP = "504B"


def licence_policy(spark: SparkSession) -> DataFrame:
    """(licence, ok, family, share_alike, why): 36 rows, so it may always be broadcast."""
    rows = [(lic, True, family, family == "share-alike",
             f"{family}: derivatives and redistribution permitted")
            for lic, family in LICENCE_FAMILY.items()]
    rows += [(lic, False, None, False, why) for lic, why in LICENCE_REFUSAL.items()]
    return spark.createDataFrame(
        rows, "licence string, ok boolean, family string, share_alike boolean, why string")
