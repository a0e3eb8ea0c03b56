from aloft.sources.readers import (load_flights, parse_airport_lines, parse_carrier_lines,
                                   parse_country_code_lines, parse_flight_lines, parse_place_lines,
                                   parse_player_lines, parse_social_lines,
                                   quarantine_csv_lines, read_airports,
                                   read_carriers, read_country_codes, read_csv_lines,
                                   read_places, read_players, read_social, read_table,
                                   table_exists)

__all__ = ["load_flights", "parse_airport_lines", "parse_carrier_lines", "parse_country_code_lines", "parse_flight_lines", "parse_place_lines", "parse_player_lines",
           "parse_social_lines", "quarantine_csv_lines", "read_airports", "read_carriers", "read_country_codes",
           "read_csv_lines", "read_places", "read_players", "read_social", "read_table",
           "table_exists"]
