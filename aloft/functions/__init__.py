from aloft.functions.columns import (EARTH_RADIUS_KM, date_from_parts, haversine_km,
                                     literal_pattern,
                                     split_words, text_flag)

__all__ = ["EARTH_RADIUS_KM", "date_from_parts", "haversine_km", "literal_pattern",
           "split_words", "text_flag"]
