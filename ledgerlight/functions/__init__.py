from ledgerlight.functions.num import (div0, greatest_strict, least_strict, to_units,
                                        trunc_to, BYTES_PER_GB, BYTES_PER_TB)
from ledgerlight.functions.text import (strip_comments, comment_metadata, tag_metadata,
                                         merge_maps, last_dot_part)

__all__ = ["div0", "greatest_strict", "least_strict", "to_units", "trunc_to",
           "BYTES_PER_GB", "BYTES_PER_TB", "strip_comments", "comment_metadata",
           "tag_metadata", "merge_maps", "last_dot_part"]
