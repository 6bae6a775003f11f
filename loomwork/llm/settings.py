"""Production parameters that the queries and the pipeline share."""

from __future__ import annotations

#: Weights of the sources in the mixture (others, and documents without a source, weigh default_weight).
MIX = {"weights": {"src0": 4, "src1": 4, "src2": 4, "src3": 4, "src4": 2, "src5": 2, "src6": 2, "src7": 2, "src8": 2, "src9": 2}, "default_weight": 1, "budget": 1.0, "max_epochs": 2, "seed": 17}
#: Key of the surrogates. A deployment passes its own secret instead.
PII_KEY = b"loomwork surrogate key"
