"""Layer runs and the query catalogue."""
