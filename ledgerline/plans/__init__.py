"""Plans: star build, views, checks, measures, reports, conflict reports."""
