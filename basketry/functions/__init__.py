from basketry.functions.formatting import itemset_key, python_tuple  # noqa: F401
from basketry.functions.hashing import (  # noqa: F401
    MINHASH_PRIME,
    PCY_BUCKETS,
    linear_hash,
    minhash_params,
    pair_bucket,
    token_hash,
)
from basketry.functions.text import words  # noqa: F401
