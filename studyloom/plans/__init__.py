"""Registered queries: operators applied to whole tables, with the SQL that gives the same rows."""
