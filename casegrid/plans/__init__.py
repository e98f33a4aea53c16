"""casegrid.plans"""
