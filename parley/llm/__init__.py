"""Operations of a training-data pipeline: quality rules and classifier,
source mixing, nearest neighbours, n-gram joins, packing, page extraction,
language identification, sharding and token files.

Nothing else in the library imports this subpackage.
"""
