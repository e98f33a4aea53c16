"""casegrid.operators"""
