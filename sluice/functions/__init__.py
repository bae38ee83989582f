"""sluice.functions"""
