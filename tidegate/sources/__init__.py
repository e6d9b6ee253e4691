"""Where messages come from and where points, backups and reports go."""
