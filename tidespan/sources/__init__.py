"""Ingress and egress."""
