"""The registered queries and the SQL that answers them in another engine."""
