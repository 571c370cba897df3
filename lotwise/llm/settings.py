"""Production parameters that queries, the pipeline and the SQL share."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The domain of a source by the number in its name; sources of other names are "other".
DOMAINS = {"web": range(0, 10), "books": range(10, 15), "code": range(15, 20)}

# Weights of nodes (domain, language, source); nodes that are not named have weight 1.
MIX_WEIGHTS: dict[tuple[str, ...], int] = {
    ("web",): 5, ("books",): 3, ("code",): 2, ("other",): 1,
    ("web", "en"): 6, ("web", "de"): 2, ("web", "fr"): 2, ("web", "es"): 1,
    ("books", "en"): 2, ("books", "fr"): 3,
    ("code", "en"): 4, ("code", "es"): 2,
    ("web", "en", "src0"): 2, ("web", "en", "src3"): 3, ("books", "fr", "src12"): 4,
}
MIX_SHARE = (9, 10)       # the budget is nine tenths of all tokens
MIX_EPOCHS, MIX_SEED = 3, 11


def mix_levels() -> dict[str, Column]:
    domain = F.lit("other")
    for name, numbers in DOMAINS.items():
        domain = F.when(F.col("source").isin([f"src{k}" for k in numbers]), F.lit(name)).otherwise(domain)
    return {"domain": domain, "language": F.col("lang"), "source_name": F.col("source")}
