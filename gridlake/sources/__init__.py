"""Readers and generators: every way data enters gridlake."""
