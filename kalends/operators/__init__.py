"""Operators on tables of listings: classifiers, lookups, survivors, quality, schedules, candidates, reports."""
