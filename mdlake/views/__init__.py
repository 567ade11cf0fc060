"""Registered checks: every operator run over whole tables, each with its SQL counterpart."""
