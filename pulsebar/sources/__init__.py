"""Message sources, landed tables and where jobs may keep their files."""
