"""Column functions: text cleaning, identity, time, tags, fields, line protocol, places."""
