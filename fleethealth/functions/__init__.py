from fleethealth.functions.expr import (  # noqa: F401
    STORED, bt, dot, micros, norm, null_if_nan, new_rows_only, packed, rounded, r5, slice_of, stored_value, total_order,
    unpacked, vector_norm,
)
