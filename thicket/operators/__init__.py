"""DataFrame operators on normalized occurrences: gbifID, sci, taxonKey, lat, lon, y, m, eventDate, country, lastInterpreted."""
