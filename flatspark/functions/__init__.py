from flatspark.functions.scalars import (
    full_name,
    full_name_parts,
    joined_record,
    partition_date,
    printed_list,
    profile_short,
    reference_id,
    trailing_token,
    yes_no,
    zero_pad,
)

__all__ = [
    "full_name",
    "full_name_parts",
    "joined_record",
    "partition_date",
    "printed_list",
    "profile_short",
    "reference_id",
    "trailing_token",
    "yes_no",
    "zero_pad",
]
