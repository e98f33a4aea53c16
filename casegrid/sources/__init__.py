"""casegrid.sources"""
