"""Parameters of the registered queries and the pipeline."""

#: Target weights of the mixture by source; all other sources share ``OTHER_WEIGHT``.
TARGET_WEIGHTS = {"src0": 4.0} | {f"src{k}": 1.0 for k in range(1, 12)}
OTHER_WEIGHT, MIX_SEED = 5.0, 1
