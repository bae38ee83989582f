"""sluice.operators"""
