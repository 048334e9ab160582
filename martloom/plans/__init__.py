"""Reports over the star schema, and the daily load that fills it."""
