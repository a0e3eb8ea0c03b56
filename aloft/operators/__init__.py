"""Parameterised DataFrame operators (column names are arguments)."""

from aloft.operators.geo import count_within, radius_join, within_radius
from aloft.operators.graph import (NotConverged, edges_from_pairs, most_active, out_degree,
                                   pagerank, top_ranked, vertices_of)
from aloft.operators.joins import anti_lookup, bloom_filter, bloom_semi_filter, semi_filter, triplets
from aloft.operators.percentile import builtin_percentile, exact_percentile, grouped_percentile
from aloft.operators.ranking import running_total
from aloft.operators.relational import (conditional_share, count_by_key, domestic_only,
                                        field_mean, filter_project, filtered_max, route_counts,
                                        top1_with_lookup, two_sided_mean)
from aloft.operators.stats import least_squares
from aloft.operators.text import word_count
from aloft.operators.timeseries import moving_average, range_mean

__all__ = [
    "NotConverged", "anti_lookup", "bloom_filter", "bloom_semi_filter", "builtin_percentile", "conditional_share",
    "count_by_key", "count_within", "domestic_only", "edges_from_pairs", "exact_percentile",
    "field_mean", "filter_project", "filtered_max", "grouped_percentile", "least_squares", "most_active",
    "moving_average", "out_degree", "pagerank", "radius_join", "range_mean", "route_counts", "running_total", "semi_filter",
    "top1_with_lookup", "top_ranked", "triplets", "two_sided_mean", "vertices_of",
    "within_radius", "word_count",
]
