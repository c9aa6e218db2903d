"""DataFrame-to-DataFrame operators, grouped by the stage of a forecast's life."""
