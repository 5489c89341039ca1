from quarry.operators.clean import (  # noqa: F401
    drop_any_null, keep_columns, lift_field, rename, require,
)
from quarry.operators.dedupe import keep_first, keep_first_each  # noqa: F401
from quarry.operators.delta import (  # noqa: F401
    DuplicateKeyError, assert_unique, changed_rows, duplicate_keys, upsert_rows,
)
from quarry.operators.impute import group_means, impute_group_mean  # noqa: F401
from quarry.operators.staging import broadcast_if_small, join_small, stage  # noqa: F401
from quarry.operators.topk import top_k  # noqa: F401
